"""Line deduplication by winnowing over line hashes.

Of every WINDOW consecutive lines with words the one with the least hash is a fingerprint, so two documents
that share a run of WINDOW lines or more share a fingerprint within it. Fingerprints that occur again are
joined to their positions; around these, runs are extended both ways, window by window, as long as the lines
agree with an earlier place, and the later run is deleted. All in built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh, let, materialise, with_group

#: Shortest run of lines that is deleted, and the window from which a fingerprint is chosen.
WINDOW = 3
_BLANKS = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _solid(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _hash(line: Column) -> Column:
    """96 bits of a line without the white space at its ends."""
    bare = F.btrim(line, F.lit(_BLANKS))
    return F.struct(F.xxhash64(bare).alias("a"), F.hash(bare).alias("b"))


def fingerprints(hashes: Column, window: int = WINDOW) -> Column:
    """Positions from 0 of the least hash of each window, leftmost of equals; none if there are too few lines."""
    first = lambda h, i: i + F.array_position(F.slice(h, i + 1, window), F.array_min(F.slice(h, i + 1, window))).cast("int") - 1
    chosen = lambda h: F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: first(h, i)))
    return F.when(F.size(hashes) >= window, let(hashes, chosen)).otherwise(F.array().cast("array<int>"))


def _windows_at(hashes: Column, positions: Column, window: int) -> Column:
    """The windows that contain one of the positions: where each begins, and its key."""

    def begins(p: Column) -> Column:
        return F.sequence(F.greatest(p - (window - 1), F.lit(0)), F.least(p, F.size(hashes) - window))

    starts = F.array_distinct(F.flatten(F.transform(positions, begins)))
    one = lambda h, s: F.struct(s.alias("s"), F.xxhash64(F.slice(h, s + 1, window)).alias("k"), F.hash(F.slice(h, s + 1, window)).alias("k2"))
    return let(hashes, lambda h: F.transform(starts, lambda s: one(h, s)))


def repeated_runs(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, _starts): for each row with repeats, at which lines (with words, from 0) the windows begin that also begin earlier."""
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    hashes = F.transform(F.filter(_lines(F.col(text_col)), _solid), _hash)
    found = docs.select(F.col(id_col).alias("_id"), row.alias("_row"), hashes.alias("_h")).filter(F.size("_h") >= window)
    found = materialise(found)
    marks = found.select("_row", F.col("_h.a").alias("_a")).withColumn("_p", F.explode(fingerprints(F.col("_a"), window)))
    marks = marks.select("_row", "_p", F.get("_a", F.col("_p")).alias("_f"))
    joined = with_group(marks, ["_f"], F.col("_row"), {"_n": F.count("*")}, {"_n": F.sum("_n")}).filter("_n > 1")
    anchors = joined.groupBy("_row").agg(F.collect_set("_p").alias("_ps"))
    near = found.distinct().join(anchors, "_row")  # rows that repeat another in id and text count once
    extended = near.select("_row", "_id", F.explode(_windows_at(F.col("_h"), F.col("_ps"), window)).alias("_w"))
    keyed = extended.select("_row", F.struct(F.col("_id"), F.col("_row"), F.col("_w.s").alias("s")).alias("_at"), F.col("_w.k").alias("_k"), F.col("_w.k2").alias("_k2"))
    first = with_group(keyed, ["_k", "_k2"], F.col("_row"), {"_m": F.min("_at")}, {"_first": F.min("_m")})
    return first.filter("_at > _first").groupBy("_row").agg(F.collect_set("_at.s").alias("_starts"))


def line_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text replaced, and n_lines (lines with words) and n_removed.

    Deleted is every line within `window` consecutive lines with words (blank lines between them don't count)
    whose sequence also begins earlier: in a row with a smaller id, or earlier in the same one. Lines are equal
    if they are but for white space at their ends. Null ids come first; rows with equal ids are in an arbitrary
    but fixed order; rows equal in id and text count as one and fare alike. Blank lines stay. A null text stays
    null and has no lines; texts with fewer lines stay as they are. All columns are kept
    (n_lines and n_removed are replaced).
    """
    docs = docs.drop("n_lines", "n_removed")
    row, starts, lines_, keep_ = (fresh(n, docs.columns) for n in ("_row", "_starts", "_lines", "_keep"))
    runs = repeated_runs(docs, window, id_col, text_col).select(F.col("_row").alias(row), F.col("_starts").alias(starts))
    keyed = docs.withColumn(row, F.xxhash64(F.col(id_col), F.col(text_col)))
    both = keyed.join(runs, row, "left").withColumn(lines_, _lines(F.col(text_col)))

    def left(lines: Column) -> Column:
        solid = F.filter(F.transform(lines, lambda x, i: F.when(_solid(x), i)), lambda i: i.isNotNull())
        gone = lambda s: F.flatten(F.transform(F.col(starts), lambda a: F.transform(F.sequence(a, a + window - 1), lambda o: F.get(s, o))))
        return F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), let(solid, gone))

    keep = F.when(F.col(starts).isNotNull(), let(F.col(lines_), left))
    kept = both.withColumn(keep_, keep)
    text = F.when(F.col(keep_).isNull(), F.col(text_col)).otherwise(let(F.col(lines_), lambda x: F.array_join(F.transform(F.col(keep_), lambda i: F.get(x, i)), "\n")))
    n = F.size(F.filter(lines_, _solid)).cast("bigint")
    removed = F.coalesce(F.size(lines_) - F.size(keep_), F.lit(0)).cast("bigint")
    out = [text.alias(text_col) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*out, n.alias("n_lines"), removed.alias("n_removed"))
