"""Exact quantiles of groups of any size.

The built-in exact percentile keeps a group's distinct values on one executor. Here a bounded sketch first
brackets the ranks that are asked for; only the few values within the brackets are then counted and ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The sketch's error is at most a share 1 / ACCURACY of the ranks.
ACCURACY = 20_000


def _bracketed(df: DataFrame, keys: list[str], x: Column, p: float, accuracy: int) -> DataFrame:
    """keys, the values that may be at the ranks, how often each occurs, how many values are less, and the group's size."""
    rows = df.select(*keys, x.alias("_x")).filter("_x is not null")
    margin = 2.0 / accuracy
    low, high = (F.percentile_approx("_x", F.lit(min(1.0, max(0.0, p + d))), accuracy) for d in (-margin, margin))
    bounds = rows.groupBy(*keys).agg(low.alias("_lo"), high.alias("_hi"), F.count("*").alias("_n"))
    # the nearest values beyond the brackets are kept too: ranks are rounded differently
    if not keys:
        joined = rows.crossJoin(F.broadcast(bounds))  # bounds is one row
    else:
        renamed = bounds.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_lo", "_hi", "_n")
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        joined = rows.join(renamed, same)
    counted = joined.groupBy(*keys, "_n", F.when(F.col("_x") < F.col("_lo"), None).when(F.col("_x") > F.col("_hi"), None).otherwise(F.col("_x")).alias("_x"), (F.col("_x") < F.col("_lo")).alias("_less"), (F.col("_x") > F.col("_hi")).alias("_more")).agg(F.count("*").alias("_c"), F.min(F.when(F.col("_x") > F.col("_hi"), F.col("_x"))).alias("_next"), F.max(F.when(F.col("_x") < F.col("_lo"), F.col("_x"))).alias("_last"))
    below = Window.partitionBy(*keys).orderBy(F.desc("_less"), "_more", "_x").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("_before", F.coalesce(F.sum("_c").over(below), F.lit(0).cast("bigint")))


def exact_quantile(df: DataFrame, keys: list[str], x: Column, p: float, name: str = "q", interpolate: bool = True, accuracy: int = ACCURACY) -> DataFrame:
    """keys and the quantile: interpolated between neighbours as percentile_cont, or a value as percentile_disc.

    Nulls don't count; groups without values have no row. Null keys are a group.
    """
    found = _bracketed(df, keys, x, p, accuracy)
    at = F.lit(p) * (F.col("_n") - 1) if interpolate else F.greatest(F.ceil(F.lit(p) * F.col("_n")) - 1, F.lit(0))
    value = F.coalesce("_x", "_next", "_last").cast("double")
    holds = lambda r: (F.col("_before") <= r) & (r < F.col("_before") + F.col("_c"))
    low = F.max(F.when(holds(F.floor(at)), value))
    high = F.max(F.when(holds(F.ceil(at)), value))
    share = F.max(at - F.floor(at))
    return found.groupBy(*keys).agg(F.when(low == high, low).otherwise(low * (1 - share) + high * share).alias(name) if interpolate else low.alias(name))
