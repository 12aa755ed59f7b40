"""What the operators of this package share."""

from __future__ import annotations

import atexit
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache
from inspect import signature

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every contract here, as a Java pattern.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Runs that replacing by one space would change; a lone space is left alone, which saves most of the work.
_ODD_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
#: Least number of sub-keys over which one group's rows are dealt when they fetch what was computed for the group.
SALTS = 64
#: Rows of whole texts that a Parquet reader and what goes to Python take at a time: a reader's batch of thousands is one array of many MB.
TEXT_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": 128, "spark.sql.execution.arrow.maxRecordsPerBatch": 1000}

_written: dict[str, SparkSession] = {}
_noted: ContextVar[list[str] | None] = ContextVar("_noted", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where none is set, a temporary one, if all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quarry-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """df, written as a table in the shared folder and read again: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quarry/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written[path] = spark
    if (noted := _noted.get()) is not None:
        noted.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """What the session runs within takes TEXT_ROWS at a time, or fewer if it is set so; its settings are then as they were."""
    given = spark.conf.getAll
    before = {k: given.get(k) for k in TEXT_ROWS}
    try:
        for k, most in TEXT_ROWS.items():
            now = int(spark.conf.get(k))
            spark.conf.set(k, min(now, most) if now > 0 else most)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    """The C library's malloc_trim(), or nothing where it has none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda _: 0


def give_back() -> None:
    """What this process has freed goes back to the system; a reused worker would keep what its largest batch took, also while only the JVM has work."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def lean(f: Callable) -> Callable:
    """f, for applyInArrow (tables of 1 to 3 arguments), with give_back() after each group. Spark counts the parameters."""

    def one(a):
        try:
            return f(a)
        finally:
            give_back()

    def two(a, b):
        try:
            return f(a, b)
        finally:
            give_back()

    def three(a, b, c):
        try:
            return f(a, b, c)
        finally:
            give_back()

    return (one, two, three)[len(signature(f).parameters) - 1]


def lean_batches(f: Callable) -> Callable:
    """f, for mapInArrow, with give_back() after each batch and at the end."""

    def run(batches):
        try:
            for b in f(batches):
                yield b
                del b
                give_back()
        finally:
            give_back()

    return run


@contextmanager
def noting() -> Iterator[list[str]]:
    """The folders of tables that materialise() writes within, by this thread, in order."""
    paths: list[str] = []
    token = _noted.set(paths)
    try:
        yield paths
    finally:
        _noted.reset(token)


def release(spark: SparkSession | None = None, paths: list[str] | None = None) -> None:
    """Delete what materialise() has written, or of that these paths; DataFrames that read it must not be used afterwards."""
    for path, owner in list(_written.items()):
        if (spark is None or owner is spark) and (paths is None or path in paths):
            _written.pop(path)
            try:
                jvm = owner.sparkContext._jvm
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(owner.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
            except Exception:  # noqa: BLE001  the session may be gone; the cluster's own cleaning takes the folder
                continue


atexit.register(release)


def fresh(name: str, columns: list[str]) -> str:
    """name, with underscores before it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def squeezed(text: Column) -> Column:
    """Null as empty; each run of white space replaced by one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _ODD_SPACE, " ")


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it within a lambda."""
    return F.transform(F.array(value), body)[0]


def with_group(df: DataFrame, keys: list[str], salt_by: Column, parts: dict[str, Column], whole: dict[str, Column], salts: int | None = None) -> DataFrame:
    """Add to each row what is aggregated over its group, without bringing a group's rows together.

    parts: partial aggregates by (keys, salt). whole: aggregates of those by keys. Each group's result
    then goes to the salts that it occurs with, at most `salts` rows, and is joined on (keys, salt):
    a group that holds a third of all rows is read by many tasks. salts: by default as many as a shuffle has
    partitions, SALTS at least, so that the largest group's share of a task shrinks as the cluster grows.
    """
    salts = salts or max(SALTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    part = salted.groupBy(*keys, "_salt").agg(*[c.alias(n) for n, c in parts.items()])
    total = part.groupBy(*keys).agg(*[c.alias(n) for n, c in whole.items()], F.collect_set("_salt").alias("_salts"))
    spread = total.withColumn("_salt", F.explode("_salts")).drop("_salts")
    return salted.join(spread, [*keys, "_salt"]).drop("_salt")
