"""A Spark data source that sends SQL to a server over HTTP and reads its tab-separated answer, and inserts the same way.

    spark.dataSource.register(HttpSql)
    spark.read.format("http_sql").schema(...).option("url", "http://host:8123/").option("query", "select ...").load()

With `partitions` and a `{part}` in the query, each task sends its own statement, so that large answers are
read by many tasks; so they are with `partition_column`, `lower` and `upper`, which cut a whole-number column into
ranges (rows beyond the bounds and nulls are read too). Without, one task reads all. `where` is a condition that
the server applies, `limit` bounds the rows of each task's answer. Answers are streamed and handed on in Arrow
batches, never held whole.

Spark's own filters stay with Spark: in PySpark 4.1 what a Python source is told to filter stays with the relation, so
that another query on the same DataFrame gets the first one's rows (tests/test_http_and_sql.py shows that none do here).

Inserts carry a token made of the write, the task and the place of a request within the task, in the setting
`insert_deduplication_token`: where a server heeds it, a task that Spark runs again adds no rows, if the rows come in
the same order. Where it doesn't, such a task's rows are there twice.
"""

from __future__ import annotations

import datetime as dt
import decimal
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_type

from quarry.sources.tsv import ESCAPES, NULL

#: Attempts at a statement whose connection fails before rows came.
ATTEMPTS = 3
#: Bytes of rows that are sent in one request.
SEND_BYTES = 8 << 20
#: Rows of an Arrow batch.
BATCH_ROWS = 8192
_OPTIONS = ("url", "query", "table", "user", "password", "settings", "partitions", "timeout", "partition_column", "lower", "upper", "limit", "where")


def _unescaped(field: str) -> str | None:
    if field == NULL:
        return None
    if "\\" not in field:
        return field
    out, i = [], 0
    while i < len(field):
        if field[i] == "\\" and i + 1 < len(field):
            out.append(ESCAPES.get(field[i + 1], field[i : i + 2]))
            i += 2
        else:
            out.append(field[i])
            i += 1
    return "".join(out)


def _array(text: str, parse) -> list:
    """An array's text, items quoted or not, arrays within arrays; parse: of an unquoted or quoted item's value (inner arrays as text)."""
    items, i, depth, begin = [], 1, 0, 1

    def item(raw: str):
        raw = raw.strip()
        if raw == "NULL":
            return None
        return parse(_unescaped(raw[1:-1]) if raw[:1] == "'" else raw)

    while i < len(text):
        c = text[i]
        if c == "'":  # to the quote that ends it
            i += 1
            while i < len(text) and text[i] != "'":
                i += 2 if text[i] == "\\" else 1
        elif c == "[":
            depth += 1
        elif (c == "," and not depth) or (c == "]" and not depth):
            if text[begin:i].strip():
                items.append(item(text[begin:i]))
            begin = i + 1
        elif c == "]":
            depth -= 1
        i += 1
    return items


def _escaped(value) -> str:
    if value is None:
        return NULL
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join("'" + _escaped(x) + "'" if isinstance(x, str) else _escaped(x) if isinstance(x, (list, tuple)) else "NULL" if x is None else str(x) for x in value) + "]"
    text = str(value).replace("\\", "\\\\")
    for letter, character in ESCAPES.items():
        if character != "\\":
            text = text.replace(character, "\\" + letter)
    return text


def _parser(kind: T.DataType):
    if isinstance(kind, T.BooleanType):
        return lambda s: s in ("1", "true")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float
    if isinstance(kind, T.DecimalType):
        return decimal.Decimal
    if isinstance(kind, T.DateType):
        return lambda s: None if s.startswith("0000") else dt.date.fromisoformat(s)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return lambda s: None if s.startswith("0000") else dt.datetime.fromisoformat(s)
    if isinstance(kind, T.ArrayType):
        return lambda s: _array(s, _parser(kind.elementType))
    return lambda s: s


class Client:
    """Sends statements; the password goes in a header and is not shown."""

    def __init__(self, options: dict[str, str]) -> None:
        unknown = [k for k in options if k.lower() not in _OPTIONS and k != "path"]
        if unknown:
            raise ValueError(f"invalid option {unknown[0]!r}; valid ones are {', '.join(_OPTIONS)}")
        if "url" not in options:
            raise ValueError("the option url is missing")
        from quarry.sources.settings import DEFAULTS, parse

        self.options = dict(options)
        self.settings = parse(options.get("settings", DEFAULTS))

    def open(self, sql: str, body: bytes = b"", attempts: int = ATTEMPTS, **settings: str):
        """The answer to a statement. An insert is sent once by a task: whether a lost one arrived cannot be known."""
        named = {"query_id": str(uuid.uuid4())} | self.settings | settings | ({"query": sql} if body else {})
        request = urllib.request.Request(self.options["url"] + "?" + urllib.parse.urlencode(named), data=body or sql.encode(), method="POST")
        if self.options.get("user"):
            request.add_header("X-User", self.options["user"])
            request.add_header("X-Key", self.options.get("password", ""))
        for left in reversed(range(attempts)):
            try:
                return urllib.request.urlopen(request, timeout=float(self.options.get("timeout", "300")))
            except urllib.error.HTTPError as e:
                raise RuntimeError(f"the server refused the statement ({e.code}): {e.read(2000).decode(errors='replace')}") from None
            except (urllib.error.URLError, ConnectionError):
                if not left:
                    raise
                time.sleep(0.2)


def quoted(text: str) -> str:
    """A text as a literal of a statement."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.schema, self.client = schema, Client(options)
        self.query, self.table, self.limit = options.get("query"), options.get("table"), options.get("limit")
        self.n = int(options.get("partitions", "1"))
        self.by = options.get("partition_column")
        self.where = [f"({options['where']})"] if options.get("where") else []
        if self.by and not ("lower" in options and "upper" in options):
            raise ValueError("partition_column needs lower and upper")
        self.bounds = (int(options["lower"]), int(options["upper"])) if self.by else (0, 0)
        if self.n > 1 and not self.by and "{part}" not in (self.query or ""):
            raise ValueError("a query for several partitions needs {part} in it, or a partition_column")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.n)]

    def _slice(self, part: int) -> list[str]:
        """The range of partition_column that is this partition's; the outer ones are open."""
        if not self.by or self.n == 1:
            return []
        low, high = self.bounds
        cut = [low + (high - low) * i // self.n for i in (part, part + 1)]
        if part == 0:
            return [f"({self.by} < {cut[1]} or {self.by} is null)"]
        return [f"{self.by} >= {cut[0]}"] + ([f"{self.by} < {cut[1]}"] if part < self.n - 1 else [])

    def statement(self, part: int) -> str:
        where = self._slice(part) + self.where
        named = f"select {', '.join(self.schema.names)} from "
        if not self.query:
            sql = named + str(self.table)
        else:
            sql = self.query.replace("{part}", str(part)) if self.n > 1 else self.query
            sql = f"{named}({sql}) as q" if where or self.limit else sql
        return sql + (" where " + " and ".join(where) if where else "") + (f" limit {int(self.limit)}" if self.limit else "")

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        batch: list[list[str]] = []
        with self.client.open(self.statement(partition.value)) as answer:
            for line in answer:  # newlines within fields are escaped
                batch.append(line.decode().rstrip("\n").split("\t"))
                if len(batch) == BATCH_ROWS:
                    yield self._batch(batch)
                    batch = []
        if batch:
            yield self._batch(batch)

    def _batch(self, lines: list[list[str]]) -> pa.RecordBatch:
        columns = [_column(texts, f.dataType) for texts, f in zip(zip(*lines), self.schema)]
        return pa.RecordBatch.from_arrays(columns, self.schema.names)


def _column(texts: tuple[str, ...], kind: T.DataType) -> pa.Array:
    known = [None if x == NULL else x for x in texts]
    arrow = to_arrow_type(kind)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return pa.array(known, pa.string()).cast(arrow)
    parse = _parser(kind)
    if not isinstance(kind, T.ArrayType):  # an array's items have escapes of their own
        known = [None if x is None else _unescaped(x) for x in known]
    values = [None if x is None else parse(x) for x in known]
    if isinstance(kind, T.TimestampType):
        values = [None if x is None else x.astimezone(dt.timezone.utc) for x in values]
    return pa.array(values, arrow)


class _Writer(DataSourceWriter):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.client, self.id = Client(options), uuid.uuid4().hex
        self.sql = f"INSERT INTO {options['table']} ({', '.join(schema.names)}) FORMAT TSV"

    def write(self, rows: Iterator) -> WriterCommitMessage:
        held, size, sent = [], 0, 0
        for row in rows:
            held.append("\t".join(map(_escaped, row)) + "\n")
            size += len(held[-1])
            if size >= SEND_BYTES:
                self._send(held, sent)
                held, size, sent = [], 0, sent + 1
        if held:
            self._send(held, sent)
        return WriterCommitMessage()

    def _send(self, rows: list[str], sent: int) -> None:
        task = TaskContext.get()
        token = f"{self.id}-{task.partitionId() if task else 0}-{sent}"
        self.client.open(self.sql, "".join(rows).encode(), attempts=1, insert_deduplication_token=token).close()


class HttpSql(DataSource):
    @classmethod
    def name(cls) -> str:
        return "http_sql"

    def schema(self):
        raise ValueError("http_sql needs a schema: import or declare one")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("http_sql only appends")
        return _Writer(schema, dict(self.options))
