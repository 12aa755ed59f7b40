"""Joins that Spark has no operator for, made of its windows and equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators.aggregates import arg_max


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, take: list[str]) -> DataFrame:
    """left with `take` from the right row of the same key with the greatest `on` that is not after left's; null if none.

    Of right rows at the same time the one with the greatest taken values counts. One shuffle by key, sorted
    by time, no pairs; a key's rows are streamed through one window.
    """
    value = F.struct(*take)
    ends = right.groupBy(*by, on).agg(F.max(value).alias("_v"))  # map-side, so ties cost nothing
    both = left.select(*by, on, F.struct("*").alias("_row"), F.lit(None).cast(ends.schema["_v"].dataType).alias("_v"), F.lit(1).alias("_side")).unionByName(
        ends.select(*by, on, F.lit(None).cast(left.select(F.struct("*").alias("r")).schema["r"].dataType).alias("_row"), "_v", F.lit(0).alias("_side"))
    )
    so_far = Window.partitionBy(*by).orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_v", F.last("_v", ignorenulls=True).over(so_far)).filter("_side = 1")
    return found.select("_row.*", *[F.col(f"_v.{c}").alias(c) for c in take])


def range_join(points: DataFrame, spans: DataFrame, at: str, low: str, high: str, width: int) -> DataFrame:
    """Pairs with low <= at < high, by an equi-join on slots of `width` (about a usual span's length): each span is listed in the slots it meets."""
    slot = lambda c: F.floor(F.col(c) / width)
    listed = spans.withColumn("_slot", F.explode(F.sequence(slot(low), F.floor((F.col(high) - 1) / width))))
    joined = points.withColumn("_slot", slot(at)).join(listed, "_slot").filter((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high)))
    return joined.drop("_slot")


def latest_by(df: DataFrame, keys: list[str], on: str, take: list[str]) -> DataFrame:
    """For each key the values at its greatest `on`."""
    return df.groupBy(*keys).agg(*[arg_max(F.col(c), F.col(on)).alias(c) for c in take])
