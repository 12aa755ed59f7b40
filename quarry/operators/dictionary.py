"""Dictionaries: look-ups of attributes by key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dictionary:
    """A table with unique keys, one or several columns.

    Look-ups are left joins. Spark sends the table to every executor if its measured size allows, else it
    shuffles both sides and splits keys that are asked for too often.
    """

    table: DataFrame
    keys: tuple[str, ...]

    def get(self, df: DataFrame, attribute: str, by: list[Column], name: str, default: object = "") -> DataFrame:
        """df with `name`: the attribute at the key, the default if the key isn't there (an attribute that is null stays so)."""
        part = self.table.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], F.struct(F.col(attribute).alias("v")).alias("_v"))
        if len(by) != len(self.keys):
            raise ValueError(f"the dictionary has {len(self.keys)} key columns, not {len(by)}")
        on = [F.col(f"_b{i}") == F.col(f"_k{i}") for i in range(len(by))]
        sides = df.withColumns({f"_b{i}": c for i, c in enumerate(by)})
        joined = sides.join(part, on, "left")
        value = F.when(F.col("_v").isNull(), F.lit(default)).otherwise(F.col("_v.v"))
        return joined.select(*[F.col(f"`{c}`") for c in df.columns], value.alias(name))
