"""Quality rules: a table of thresholds compiled into one projection of built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, let

#: Frequent function words of the four languages that the rules know.
STOP_WORDS = {
    "en": "the of and to in a is that it for on with as was by this are from at an be or not have he",
    "fr": "le la les de des du et un une en à est que qui dans pour par sur au ne pas ce il se avec",
    "de": "der die das und in zu den von mit ist ein eine des dem nicht auf als für im sich es auch an er",
    "es": "el la los de las y en un una que es por con para se no su al del lo como más pero sus",
}
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8

#: name, statistic of `stats`, least, most (null: no bound). A document is kept if every one holds.
RULES: list[tuple[str, str, float | None, float | None]] = [
    ("mean_word_length", "mean_word_length", 2.0, 14.0),
    ("symbol_ratio", "symbol_ratio", None, 0.2),
    ("bang_ratio", "bang_ratio", None, 0.3),
    ("stop_word_ratio", "stop_word_ratio", 0.02, None),
    ("dup_line_ratio", "dup_line_ratio", None, 0.5),
    ("stutter_ratio", "stutter_ratio", None, 0.3),
    ("ellipsis_line_ratio", "ellipsis_line_ratio", None, 0.3),
    ("bullet_line_ratio", "bullet_line_ratio", None, 0.9),
]


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words that windows of `width` words cover which occur twice or more, the first included."""

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda p, j: F.least(F.lit(width), F.coalesce(F.get(starts, j + 1) - p, F.lit(width)))),
            F.lit(0).cast("bigint"), lambda a, x: a + x,
        )

    def repeats(pairs: Column) -> Column:
        same = F.filter(pairs, lambda p, j: F.coalesce(F.get(pairs, j + 1)["h"] == p["h"], F.lit(False)) | F.coalesce(F.get(pairs, j - 1)["h"] == p["h"], F.lit(False)))
        return let(F.sort_array(F.transform(same, lambda p: p["i"])), covered)

    def of_windows(keys: Column) -> Column:
        pairs = F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("bigint")).otherwise(let(pairs, repeats))

    def of_hashes(hashes: Column) -> Column:
        keys = F.transform(F.sequence(F.lit(1), F.size(hashes) - (width - 1)), lambda i: F.xxhash64(F.slice(hashes, i, width)))
        return F.when(F.size(hashes) <= width, F.lit(0).cast("bigint")).otherwise(let(keys, of_windows))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each text; a null text has no words and no lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text")).select(
        "doc_id", "_text",
        F.filter(F.split("_text", f"{SPACE}+"), lambda w: w != "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    stop = sorted({w for s in STOP_WORDS.values() for w in s.split()})
    n = lambda c: c.cast("bigint")
    return cut.select(
        "doc_id",
        n(F.size("_words")).alias("n_words"),
        n(F.length(F.array_join("_words", ""))).alias("word_chars"),
        n(F.regexp_count("_text", F.lit(SYMBOLS))).alias("n_symbols"),
        n(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        n(F.size("_lines")).alias("n_lines"),
        n(F.regexp_count("_text", F.lit("!!"))).alias("n_bangs"),
        n(F.size(F.filter("_words", lambda w: F.lower(w).isin(stop)))).alias("n_stop_words"),
        n(let(F.col("_words"), lambda ws: F.size(F.filter(ws, lambda w, i: (i > 0) & (F.get(ws, i - 1) == w))))).alias("n_stutters"),
        n(F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*\z")))).alias("n_ellipsis_lines"),
        n(F.size(F.filter("_lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-•*][\x20\x09-\x0D]")))).alias("n_bullet_lines"),
    )


def ratios() -> dict[str, Column]:
    over = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "mean_word_length": over("word_chars", "n_words"), "symbol_ratio": over("n_symbols", "n_words"), "bang_ratio": over("n_bangs", "n_words"),
        "stop_word_ratio": over("n_stop_words", "n_words"), "stutter_ratio": over("n_stutters", "n_words"), "dup_line_ratio": over("n_dup_lines", "n_lines"),
        "ellipsis_line_ratio": over("n_ellipsis_lines", "n_lines"), "bullet_line_ratio": over("n_bullet_lines", "n_lines"),
    }


def verdict(rules: list[tuple[str, str, float | None, float | None]] = RULES) -> Column:
    """The table as one boolean expression."""
    stats = ratios()
    bounds = [b for _, s, low, high in rules for b in ([stats[s] >= low] if low is not None else []) + ([stats[s] <= high] if high is not None else [])]
    return reduce(lambda a, b: a & b, bounds, F.lit(True))


def quality_rules(docs: DataFrame, rules: list[tuple[str, str, float | None, float | None]] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the counts, base_failed, kept and the statistics that the rules use.

    Null or empty texts have zero counts; with under 20 words base_failed is true and kept false.
    Repeated rows are judged each for itself; other columns are ignored.
    """
    counted = statistics(docs, id_col, text_col)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
    )
