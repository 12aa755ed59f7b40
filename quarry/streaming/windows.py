"""Windows over time that run alike over batches and streams.

Streams need a watermark on a zoned timestamp: there, event times without a zone are read in the session's.
Batches keep them as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def event_time(df: DataFrame, ts: str, lateness: str | None = None) -> DataFrame:
    """A stream with ts as a zoned timestamp and a watermark that lets rows be `lateness` late; a batch as it is."""
    if not df.isStreaming:
        return df
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, lateness) if lateness else df


def _windowed(df: DataFrame, window: Column, keys: list[str], aggregates: list[Column]) -> DataFrame:
    return df.groupBy(window.alias("_w"), *keys).agg(*aggregates).select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), "*").drop("_w")


def tumbling(df: DataFrame, ts: str, width: str, keys: list[str], aggregates: list[Column], lateness: str | None = None) -> DataFrame:
    return _windowed(event_time(df, ts, lateness), F.window(ts, width), keys, aggregates)


def sliding(df: DataFrame, ts: str, width: str, step: str, keys: list[str], aggregates: list[Column], lateness: str | None = None) -> DataFrame:
    return _windowed(event_time(df, ts, lateness), F.window(ts, width, step), keys, aggregates)


def session(df: DataFrame, ts: str, gap: str, keys: list[str], aggregates: list[Column], lateness: str | None = None) -> DataFrame:
    """Sessions of each key that end after a gap without rows."""
    return _windowed(event_time(df, ts, lateness), F.session_window(ts, gap), keys, aggregates)


def distinct_within(df: DataFrame, ts: str, keys: list[str], lateness: str) -> DataFrame:
    """The first row of each key within the watermark; over a batch the first row of each key."""
    timed = event_time(df, ts, lateness)
    return timed.dropDuplicatesWithinWatermark(keys) if df.isStreaming else timed.dropDuplicates(keys)


def read_files(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the Parquet files that appear in a folder."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)
