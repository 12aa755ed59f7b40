"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram's vector binds its letters: the first letter's vector
permuted twice, times the second's permuted once, times the third's. A document's vector bundles (sums) its
trigrams; a language's prototype bundles its documents, each at the same weight. A document gets the language
whose prototype makes the largest cosine with its vector. Bundling is linear, so partitions sum their shares.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import lean, lean_batches

DIMENSIONS = 1024
SEED = 20240229
UNDETERMINED = "und"
#: Learned rows that a class of lengths needs for a bound on scores, and the share of their least score that is the bound.
LEAST_ROWS, MARGIN = 100, 0.5
#: Documents and characters that are looked at together; bounds a worker's memory, not what is read.
_DOCS, _CHARS = 256, 400_000
#: Beyond so many possible trigrams they are found by sorting instead of in a table.
_TABLE = 1 << 22


@lru_cache(maxsize=20_000)
def letter(code: int) -> np.ndarray:
    """The random vector of a character; 0 is the boundary of a word."""
    return np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS, np.int8) * np.int8(2) - np.int8(1)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point itself, if it is a letter, else 0."""
    return np.array([c if chr(c).isalpha() else 0 for c in range(0x110000)], np.uint32)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of the characters of each distinct trigram, which trigram, in which text) over all of the texts."""
    codes, where = [], []
    for i, text in enumerate(texts):
        if text:
            own = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
            if own.any():
                own = np.concatenate([[0], own, [0]])
                own = own[(own != 0) | np.append(True, own[:-1] != 0)]
                codes.append(own)
                where.append(np.full(len(own), i, np.int32))
    if not codes:
        return np.empty((0, 3), np.uint32), np.empty(0, np.int64), np.empty(0, np.int32)
    code, doc = np.concatenate(codes), np.concatenate(where)
    seen = np.zeros(int(code.max()) + 1, bool)
    seen[code] = True
    alphabet = np.flatnonzero(seen)
    index = np.zeros(len(seen), np.int64)
    index[alphabet] = np.arange(len(alphabet))
    n, x = len(alphabet), index[code]
    key, same = (x[:-2] * n + x[1:-1]) * n + x[2:], doc[:-2] == doc[2:]
    key, doc = key[same], doc[:-2][same]
    if n**3 <= _TABLE:
        there = np.zeros(n**3, bool)
        there[key] = True
        distinct = np.flatnonzero(there)
        place = np.zeros(n**3, np.int64)
        place[distinct] = np.arange(len(distinct))
        which = place[key]
    else:
        distinct, which = np.unique(key, return_inverse=True)
    return alphabet[np.stack([distinct // n // n, distinct // n % n, distinct % n], 1)], which, doc


def bound(grams: np.ndarray) -> np.ndarray:
    """The vectors of trigrams, one a row."""
    used, at = np.unique(grams, return_inverse=True)
    at = at.reshape(grams.shape)
    v = np.stack([letter(int(c)) for c in used])
    return np.roll(v, 2, axis=1)[at[:, 0]] * np.roll(v, 1, axis=1)[at[:, 1]] * v[at[:, 2]]


def _groups(texts: list[str | None]):
    """Ranges of texts of bounded number and length (one text alone may be longer)."""
    begin, chars = 0, 0
    for i, text in enumerate(texts):
        if i > begin and (i - begin >= _DOCS or chars + len(text or "") > _CHARS):
            yield begin, i
            begin, chars = i, 0
        chars += len(text or "")
    if begin < len(texts):
        yield begin, len(texts)


def _counted(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct trigrams, counts: a row for each text)."""
    grams, which, doc = trigrams(texts)
    u = len(grams)
    counts = np.bincount(doc.astype(np.int64) * u + which, minlength=len(texts) * u) if u else np.zeros(0)
    return grams, counts.reshape(len(texts), u).astype(np.float32)


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls on the fold; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, np.ndarray]:
    """Prototypes by language. Rows with a null language, or a text without letters, teach nothing.

    The driver gets one vector for each language.
    """

    def share(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in _groups(texts):
                grams, counts = _counted(texts[i:j])
                if not len(grams):
                    continue
                counts /= np.maximum(np.sqrt((counts**2).sum(1, keepdims=True)), 1e-9)
                vectors = bound(grams).astype(np.float32)
                own = np.array(langs[i:j])
                for lang in set(langs[i:j]):
                    total = counts[own == lang].sum(0, dtype=np.float64) @ vectors
                    sums[lang] = sums.get(lang, 0) + total
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.astype("<f8").tobytes() for v in sums.values()], pa.binary())], ["lang", "sums"])

    def add(t: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, "<f8") for x in t["sums"].to_pylist()], axis=0)
        return pa.table({"lang": t["lang"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    known = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    parts = known.mapInArrow(lean_batches(share), "lang string, sums binary").withColumn("part", F.spark_partition_id() % 64)
    some = parts.groupBy("lang", "part").applyInArrow(lean(lambda t: add(t.select(["lang", "sums"]))), "lang string, sums binary")
    rows = some.groupBy("lang").applyInArrow(lean(add), "lang string, sums binary").collect()
    return {r["lang"]: np.frombuffer(r["sums"], "<f8") for r in sorted(rows, key=lambda r: r["lang"])}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score (the cosine, at least 0).

    A null text or one without letters gets `und` and score 0, as all texts do without prototypes. Of equal
    cosines the first language in order of name wins. Repeated rows are judged each for itself.
    Columns called lang_pred and score are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    langs = sorted(prototypes)
    matrix = np.stack([prototypes[x] / max(np.linalg.norm(prototypes[x]), 1e-12) for x in langs], 1).astype(np.float32) if langs else None
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            found, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            for i, j in _groups(texts) if langs else ():
                grams, counts = _counted(texts[i:j])
                if not len(grams):
                    continue
                vectors = counts @ bound(grams).astype(np.float32)
                cosine = (vectors @ matrix) / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                best = cosine.argmax(1)
                for k in np.flatnonzero(counts.any(1)):
                    found[i + k] = langs[best[k]]
                    score[i + k] = round(min(1.0, max(0.0, float(cosine[k, best[k]]))), 6)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lean_batches(run), f"{schema}, lang_pred string, score double")


def _size_class(text: Column) -> Column:
    """Documents of like length: the number of binary digits of the number of characters."""
    return F.length(F.bin(F.length(F.coalesce(text, F.lit("")))))


def score_bounds(judged: DataFrame, text_col: str = "text") -> dict[int, float]:
    """By class of length, MARGIN times the least score of identify() among rows that the prototypes were learned from.

    Classes with fewer than LEAST_ROWS rows have no bound, and the driver gets one row a class.
    """
    of = judged.filter(F.col("lang_pred") != UNDETERMINED).groupBy(_size_class(F.col(text_col)).alias("k")).agg(F.count("*").alias("n"), F.min("score").alias("least"))
    return {r["k"]: MARGIN * r["least"] for r in of.collect() if r["n"] >= LEAST_ROWS}


def accepted(bounds: dict[int, float], text_col: str = "text") -> Column:
    """Whether a row that identify() judged has a language, and a score that is not below the bound of its length."""
    kind, bound = _size_class(F.col(text_col)), F.lit(0.0)
    for k, v in bounds.items():
        bound = F.when(kind == k, v).otherwise(bound)
    return (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= bound)


def language_id(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learned from the documents that are not held out."""
    out = held_out(F.col("doc_id"), folds, fold)
    prototypes = fit(docs.filter(~out & F.col("doc_id").isNotNull()))
    return identify(docs.select("doc_id", "text"), prototypes).select("doc_id", out.alias("held_out"), "lang_pred", "score")
