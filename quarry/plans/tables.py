"""Access to the tables that the registered queries read, and the money types that they sum exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str | Column) -> Column:
    """A double with cents as a decimal, so that sums don't depend on the order of rows."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(12,2)")


def revenue() -> Column:
    """Extended price after discount of a line, exact."""
    return money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))


#: The same in SQL.
REVENUE = "cast(l_extendedprice as decimal(12,2)) * (cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2)))"


def day(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")
