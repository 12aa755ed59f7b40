"""The registered queries of this package, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import quality_rules as rules
from quarry.llm.common import squeezed, table
from quarry.llm.bpe import bpe_round_trip
from quarry.llm.exact_dedup import exact_dedup
from quarry.llm.language_id import language_id
from quarry.llm.line_dedup import WINDOW, line_dedup
from quarry.llm.ngram_join import ngram_jaccard_join
from quarry.llm.packing import pack_documents
from quarry.llm.quality_classifier import quality_classifier
from quarry.llm.substring_dedup import substring_dedup
from quarry.llm.url_filter import DEFAULT, RULES, rule_table, url_filter


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer, where the installed package keeps it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.trim(squeezed(F.col("text"))), 256).alias("kept_sha256"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), rule_table(spark))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines and n_removed (lines with words), sha256 of the text that is left."""
    left = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    n = (F.length("ids") / 4).cast("bigint").alias("n_tokens")
    return both.select("doc_id", n, F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_url_filters, op3_exact_dedup, op4_ngram_jaccard_join, op5_best_fit_packing, op6_line_dedup, op7_quality_classifier, op8_quality_rules, op9_language_id, op10_bpe)
}

_S = r"[\x20\x09-\x0D]"

_OP2 = rf"""
with r(h, p, action) as (values {", ".join(str(x) for x in RULES)}),
u as (
  select row_number() over () as rid, page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path
  from pages),
b as (
  select rid, max_by(h || p, length(h || p)) as rule, max_by(action, length(h || p)) as action
  from u join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by rid)
select page_id, host, path, rule, coalesce(action, '{DEFAULT}') as verdict from u left join b using (rid)
"""

_OP3 = rf"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '{_S}+', ' ', 'g') as t from documents),
g as (select doc_id, t, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size from n)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(t) as text_sha256 from g
"""


def _op8() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted({w for s in rules.STOP_WORDS.values() for w in s.split()}))
    over = {
        "mean_word_length": "word_chars / greatest(n_words, 1)", "symbol_ratio": "n_symbols / greatest(n_words, 1)", "bang_ratio": "n_bangs / greatest(n_words, 1)",
        "stop_word_ratio": "n_stop_words / greatest(n_words, 1)", "stutter_ratio": "n_stutters / greatest(n_words, 1)", "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
        "ellipsis_line_ratio": "n_ellipsis_lines / greatest(n_lines, 1)", "bullet_line_ratio": "n_bullet_lines / greatest(n_lines, 1)",
    }
    bounds = [f"{over[s]} {op} {v}" for _, s, low, high in rules.RULES for op, v in ((">=", low), ("<=", high)) if v is not None]
    return rf"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{_S}+'), lambda w: w <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as x
  from documents),
i as (select rid, w, unnest(generate_series(1, len(w) - {rules.WINDOW - 1})) as i from d where len(w) >= {rules.WINDOW}),
g as (select rid, i, array_to_string(w[i:i + {rules.WINDOW - 1}], ' ') as g from i),
r as (select rid, i from g qualify count(*) over (partition by rid, g) > 1),
c as (select rid, count(distinct p) as n from (select rid, unnest(generate_series(i, i + {rules.WINDOW - 1})) as p from r) group by rid),
s as (
  select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, len(regexp_extract_all(t, '{rules.SYMBOLS}')) as n_symbols,
    len(x) - len(list_distinct(x)) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words, len(x) as n_lines, len(regexp_extract_all(t, '!!')) as n_bangs,
    len(list_filter(w, lambda a: lower(a) in ({stop}))) as n_stop_words,
    len(list_filter(generate_series(2, len(w)), lambda i: w[i] = w[i - 1])) as n_stutters,
    len(list_filter(x, lambda a: regexp_matches(a, '(\.\.\.|…){_S}*\z'))) as n_ellipsis_lines,
    len(list_filter(x, lambda a: regexp_matches(a, '^{_S}*[-•*]{_S}'))) as n_bullet_lines
  from d left join c using (rid)),
f as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {" and ".join(bounds)} as kept from f
"""


_OP1 = rf"""
with d as (
  select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_S}+'), lambda w: w <> '') as w from documents),
i as (select rid, doc_id, w, unnest(generate_series(1, len(w) - 19)) as i from d where len(w) >= 20),
g as (select rid, doc_id, i, array_to_string(w[i:i + 19], ' ') as g from i),
r as (select rid, i from (select rid, i, row_number() over (partition by g order by doc_id, i) as k from g) where k > 1),
p as (select distinct rid, unnest(generate_series(i, i + 19)) as i from r),
n as (select rid, count(*) as n, list(i) as gone from p group by rid)
select doc_id, len(w) as n_words, coalesce(n, 0) as n_removed,
  sha256(case when n is null then array_to_string(w, ' ') else array_to_string(list_transform(list_filter(list_zip(w, generate_series(1, len(w))), lambda x: not list_contains(gone, x[2])), lambda x: x[1]), ' ') end) as kept_sha256
from d left join n using (rid)
"""

_OP6 = rf"""
with d as (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as x from documents),
l as (select rid, doc_id, i, x[i] as line from (select rid, doc_id, x, unnest(generate_series(1, len(x))) as i from d)),
s as (select rid, doc_id, i, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line, row_number() over (partition by rid order by i) as o from l where regexp_matches(line, '[^ 	-
]')),
w as (select rid, doc_id, o, list(line) over (partition by rid order by o rows between current row and {WINDOW - 1} following) as g from s),
r as (select rid, o from (select rid, o, row_number() over (partition by g order by doc_id, o) as k from w where len(g) = {WINDOW}) where k > 1),
p as (select distinct rid, unnest(generate_series(o, o + {WINDOW - 1})) as o from r),
k as (select l.rid, l.i, l.line, s.o, p.o as gone from l left join s using (rid, i) left join p on p.rid = s.rid and p.o = s.o)
select doc_id, n_lines, n_removed, kept_sha256 from d join (
  select rid, count(o) as n_lines, count(gone) as n_removed, sha256(coalesce(string_agg(line, chr(10) order by i) filter (gone is null), '')) as kept_sha256
  from k group by rid) using (rid)
"""

ORACLES: dict[str, str] = {"op1_substring_dedup": _OP1, "op6_line_dedup": _OP6, "op2_url_filters": _OP2, "op3_exact_dedup": _OP3, "op8_quality_rules": _op8()}
