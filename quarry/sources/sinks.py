"""Inserts into tables of files, and what tables refuse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources import tsv


class UnsupportedOperation(Exception):
    """The tables are append-only."""


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df's columns by name, cast to the schema; missing ones are null. A null in a column that isn't nullable is an error when rows are written."""
    extra = [c for c in df.columns if c not in schema.names]
    if extra:
        raise ValueError(f"columns that the table doesn't have: {', '.join(extra)}")

    def one(c: T.StructField):
        value = (F.col(f"`{c.name}`") if c.name in df.columns else F.lit(None)).cast(c.dataType)
        if not c.nullable:
            if c.name not in df.columns:
                raise ValueError(f"column {c.name} must be given: it is not nullable")
            value = F.when(value.isNull(), F.raise_error(F.lit(f"null in column {c.name}, which is not nullable")).cast(c.dataType)).otherwise(value)
        return value.alias(c.name)

    return df.select(*[one(c) for c in schema])


def insert(df: DataFrame, path: str, schema: T.StructType, overwrite: bool = False) -> None:
    """Append rows to a table of Parquet files; all of them or, if the job fails, none."""
    aligned(df, schema).write.mode("overwrite" if overwrite else "append").parquet(path)


def copy_from(spark: SparkSession, source: str, path: str, schema: T.StructType) -> None:
    """Append the rows of tab-separated files."""
    insert(tsv.read(spark, source, schema), path, schema)


def update(*_: object, **__: object) -> None:
    raise UnsupportedOperation("UPDATE is not supported")


def delete(*_: object, **__: object) -> None:
    raise UnsupportedOperation("DELETE is not supported")
