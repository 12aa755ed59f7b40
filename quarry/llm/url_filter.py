"""URL filter in the manner of hash-prefix block lists.

A URL is expanded into expressions host suffix + path prefix, of the shapes that occur among the rules.
Expressions meet rules on the first 32 bits of their SHA-256; a hit counts when the full digests agree.
Of the rules that fit, the longest decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import let

#: The rules of the registered query: (host, path, action).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: A URL that no rule fits.
DEFAULT = "allow"
#: Rules of at most so many rows are sent to every executor; more are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Copies of each rule in a join by shuffle.
SALTS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, action string")


def _key(expression: Column) -> list[Column]:
    """Short prefix and full digest of an expression."""
    return [F.sha2(expression, 256).substr(1, 8).alias("_prefix"), F.sha2(expression, 256).alias("_digest")]


def url_filter(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: page_id, host, path, rule (null if none fits), verdict.

    A null url or one without `://` has an empty host and path and fits no rule. Rules with a null or empty
    host never fit. Of rules equally long the block wins; repeated rules count once; repeated pages are
    judged each for itself. Other columns are ignored.
    """
    listed = rules.filter("host <> ''").select(F.translate("host", _UPPER, _LOWER).alias("h"), F.coalesce("path", F.lit("")).alias("p"), "action")
    listed = listed.select(F.concat("h", "p").alias("_rule"), F.size(F.split("h", r"\.")).alias("_labels"), F.length("p").alias("_chars"), "action", F.struct("h", "p").alias("_parts"))
    # shapes of rules: label count by path length, some hundreds at most however long the list is
    shapes = [(r[0], r[1]) for r in listed.select("_labels", "_chars").distinct().collect()]
    few = listed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    keyed = listed.groupBy("_rule", "_parts").agg(F.max("action").alias("_action")).select("_rule", "_action", *_key(_expression(F.col("_parts.h"), F.col("_parts.p"))))
    if not shapes:
        shapes = [(1, 0)]
    cut = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), F.monotonically_increasing_id().alias("_row"))

    def expand(labels: Column) -> Column:
        each = [F.when((F.size(labels) >= n) & (F.length("path") >= c), _expression(F.array_join(F.slice(labels, -n, n), "."), F.substring("path", 1, c))) for n, c in sorted(shapes)]
        return F.array_compact(F.array(*each))

    none = F.array(F.lit(None).cast("string"))  # so that each page keeps a row; it goes where no rule is
    made = cut.withColumn("_e", F.explode(F.concat(let(F.split("host", r"\."), expand), none)))
    made = made.select("page_id", "host", "path", "_row", *_key(F.col("_e")))
    if few:
        hits = made.join(F.broadcast(keyed), ["_prefix"], "left")
    else:  # many pages share an expression: they are dealt to several copies of its rules
        nowhere = F.concat(F.lit("-"), F.col("_row").cast("string"))
        made = made.withColumn("_prefix", F.coalesce("_prefix", nowhere)).withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int"))
        keyed = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = made.join(keyed, ["_prefix", "_salt"], "left")
    confirmed = made["_digest"] == keyed["_digest"]
    best = F.max(F.when(confirmed, F.struct(F.length("_rule"), F.col("_action") == "block", F.col("_rule"), F.col("_action")))).alias("_best")
    judged = hits.groupBy("_row", "page_id", "host", "path").agg(best)
    return judged.select("page_id", "host", "path", F.col("_best._rule").alias("rule"), F.coalesce("_best._action", F.lit(default)).alias("verdict"))


def _expression(host: Column, path: Column) -> Column:
    """Host and path with a separator that no host contains."""
    return F.concat(host, F.lit("\n"), path)
