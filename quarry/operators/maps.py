"""Key to value columns held as maps or as two parallel arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def from_arrays(df: DataFrame, name: str, keys: str, values: str) -> DataFrame:
    """df with a map column from parallel arrays; of a repeated key the values are added."""
    pairs = F.arrays_zip(F.col(keys).alias("k"), F.col(values).alias("v"))
    distinct = F.array_distinct(F.col(keys))
    total = F.transform(distinct, lambda k: F.aggregate(F.filter(pairs, lambda p: p["k"] == k), F.lit(0).cast("bigint"), lambda a, p: a + p["v"]))
    return df.withColumn(name, F.map_from_arrays(distinct, total))


def sum_map(df: DataFrame, group: list[str], column: str) -> DataFrame:
    """(group..., key, value): values of all maps added by key. Long form, so no group's keys need fit in a row."""
    entries = df.select(*group, F.explode(column).alias("key", "value"))
    return entries.groupBy(*group, "key").agg(F.sum("value").alias("value"))


def collect_map(df: DataFrame, group: list[str], name: str) -> DataFrame:
    """One map for each group from the long form; a group's keys must fit in a row."""
    pairs = F.sort_array(F.collect_list(F.struct("key", "value")))
    return df.groupBy(*group).agg(F.map_from_entries(pairs).alias(name))
