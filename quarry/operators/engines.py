"""Table semantics that engines of merging tables give to reads and aggregates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Collapsing:
    """Aggregates over a table whose rows are entered with sign 1 and cancelled with sign -1.

    A cancelled row's values must equal those entered. count() of no rows is 0; avg() and sum() are null.
    """

    def __init__(self, sign: str = "sign") -> None:
        self.column, self.sign = sign, F.col(sign)

    @classmethod
    def parse(cls, engine: str) -> Collapsing:
        """From an engine option such as `CollapsingMergeTree(sign)`; without an argument the column is `sign`."""
        found = re.fullmatch(r"\s*CollapsingMergeTree\s*(?:\(\s*([A-Za-z_][A-Za-z0-9_]*)\s*\))?\s*", engine)
        if not found:
            raise ValueError(f"not a collapsing engine: {engine!r}")
        return cls(found[1] or "sign")

    def sum(self, x: Column) -> Column:
        return F.sum(x * self.sign)

    def count(self, x: Column | None = None, condition: Column | None = None) -> Column:
        here = self.sign if x is None else F.when(x.isNotNull(), self.sign)
        return F.coalesce(F.sum(here if condition is None else F.when(condition, here)), F.lit(0).cast("bigint"))

    def avg(self, x: Column) -> Column:
        return F.sum(x * self.sign) / F.nullif(F.sum(F.when(x.isNotNull(), self.sign)), F.lit(0).cast("bigint"))


def final_collapsing(df: DataFrame, keys: list[str], sign: str = "sign", order: list[str] | None = None) -> DataFrame:
    """The rows that are left when cancelled ones are gone.

    With order, columns that grow with each entry: of a key whose signs add up to more than 0 the last row that was
    entered, with sign 1, whatever values cancelled the others. Without: groups of equal rows with a positive sum of
    signs, so a key stays with several rows if cancellations had other values.
    """
    others = [c for c in df.columns if c != sign]
    if not order:
        return df.groupBy(*others).agg(F.sum(sign).alias(sign)).filter(F.col(sign) > 0)
    rest = [c for c in others if c not in keys]
    entered = F.when(F.col(sign) > 0, F.struct(*order))
    left = df.groupBy(*keys).agg(F.sum(sign).alias("_sum"), F.max_by(F.struct(*rest), entered).alias("_last")).filter("_sum > 0")
    return left.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest], F.lit(1).cast(df.schema[sign].dataType).alias(sign)).select(*df.columns)


def final_replacing(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Of each key the row with the greatest version. One aggregate with map-side combine: no key's rows meet as such."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)
