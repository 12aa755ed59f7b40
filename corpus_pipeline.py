"""The corpus pipeline: raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared
folder and rereads it as the next stage's docs. All stages but the last return the columns of documents.
SQL cannot express the pipeline (learned profiles, packing), so ORACLE_SQL is None and tests compare with
brute force. Empty tables go through all stages; nulls, empty texts and repeated rows fare as the operators say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import language_id as lid
from quarry.llm.common import fresh, materialise, noting, release, short_batches, table
from quarry.llm.line_dedup import line_dedup
from quarry.llm.ngram_join import ngram_jaccard_join, row_key
from quarry.llm.packing import pack_documents
from quarry.llm.queries import tokenizer_path
from quarry.llm.substring_dedup import substring_dedup

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _edited(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with n_chars as the text now has."""
    return docs.select(*[F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: those without a letter are rejected, and those that score below what rows of their length scored that were learned from.

    If no row teaches a language, all documents with a letter stay. Columns that are called as the operator calls its own keep their values.
    """
    aside = {c: fresh(f"_given_{c}", docs.columns) for c in docs.columns if c.lower() in ("lang_pred", "score")}
    given = docs.withColumnsRenamed(aside)
    learned = ~lid.held_out(F.col("doc_id"), 4, 2) & F.col("lang").isNotNull()
    with short_batches(spark):
        prototypes = lid.fit(given.filter(learned))
        if not prototypes:
            return docs.filter(F.col("text").rlike(r"\p{L}"))
        judged = materialise(lid.identify(given, prototypes))
    return judged.filter(lid.accepted(lid.score_bounds(judged.filter(learned)))).select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of later repeated runs."""
    with short_batches(spark):  # for the lines that line_dedup() writes
        return _edited(line_dedup(docs), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar rows one with the smallest id, and one of those with a null id. Rows count, not ids."""
    id_, key_ = fresh("_id", docs.columns), fresh("_key", docs.columns)
    with short_batches(spark):
        classes = ngram_jaccard_join(docs, rows=True)
        # rows equal in id and text are in one component: none of them stays, or one, or all (without words)
        fate = classes.groupBy(F.col("doc_id").alias(id_), F.col("key").alias(key_)).agg(F.max("first").alias("one"), F.min("first").alias("all"))
        changed = materialise(fate.filter(~F.col("all")).select(id_, key_, "one")).hint("shuffle_hash")  # ids only: texts need no sorting
    keyed = docs.withColumn(key_, row_key())
    on = lambda c: (keyed[key_] == c[key_]) & keyed["doc_id"].eqNullSafe(c[id_])
    left = keyed.join(changed, on(changed), "left_anti")
    twins = changed.filter("one").hint("shuffle_hash")
    if not twins.isEmpty():
        left = left.unionByName(keyed.join(twins, on(twins), "left_semi").dropDuplicates(["doc_id", key_]))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that occur earlier."""
    return _edited(substring_dedup(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage has written is deleted once the next one's documents are, so that the shared folder holds two stages at most."""
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        with noting() as wrote:
            docs = materialise(stage(spark, docs, sf_dir))
        release(spark, before + wrote[:-1])
        before = wrote[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
