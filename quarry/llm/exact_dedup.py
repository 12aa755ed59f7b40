"""Exact deduplication by content-defined chunk recipes.

A text is cut where its own characters say so (after punctuation and a space, at 512 characters at least
and 4096 at most), so equal texts have equal cuts. Each chunk has a 64-bit identifier and a SHA-256 digest.
Identifiers are verified over all chunks: no two digests may share one, else the digests take their place.
Documents are equal when their ordered lists of verified identifiers are; only these lists move, never
the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise, squeezed, with_group

#: Least and greatest characters of a chunk.
CHUNK = (512, 4096)


def chunks(text: Column, least: int = CHUNK[0], most: int = CHUNK[1]) -> Column:
    """Content-defined chunks of a text in order; an empty text has none."""
    pattern = rf"(?s).{{{least},{most - 3}}}?[.,;:!?)] |.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sha256 of the whole normalised text, recipe: a struct of identifier and digest for each chunk)."""
    norm = docs.select(F.col(id_col).alias("_id"), squeezed(F.col(text_col)).alias("_norm"))
    recipe = F.transform(chunks(F.col("_norm")), lambda c: F.struct(F.xxhash64(c).alias("h"), F.unhex(F.sha2(c, 256)).alias("d")))
    return norm.select("_id", F.sha2("_norm", 256).alias("text_sha256"), recipe.alias("_recipe"))


def verified(found: DataFrame) -> bool:
    """Whether each identifier stands for one digest, over all chunks of the corpus."""
    one = found.select(F.explode("_recipe").alias("c")).select("c.h", "c.d").distinct()
    return one.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and empty texts equal one another. Runs of white space count as one space,
    also at the ends. keep_id is the smallest non-null id of the group. Rows that repeat the id which stays
    are all kept; in a group with null ids alone, keep_id is null and all stay. Other columns are ignored.
    """
    found = materialise(recipes(docs, id_col, text_col))
    part = "h" if verified(found) else "d"
    listed = found.select("_id", "text_sha256", F.col(f"_recipe.{part}").alias("_list"))
    grouped = with_group(
        listed, ["_list"], F.col("_id"),
        {"_least": F.min("_id"), "_n": F.count("*")},
        {"keep_id": F.min("_least"), "group_size": F.sum("_n")},
    )
    return grouped.select(F.col("_id").alias("doc_id"), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
