"""The corpus pipeline, stage by stage, against brute force on each stage's own input."""

import ctypes
import importlib
import os
import re
from pathlib import Path

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps
from test_llm import AWKWARD, WORD, check_places, components_by_force, frame, in_order, kept_by_force, lines_by_force

from quarry.llm import common
from quarry.llm.common import TEXT_ROWS, materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The input and then each stage's output over rows of documents and awkward ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id >= 40").unionByName(frame(spark, AWKWARD))
    found = [materialise(docs)]
    for _, stage in corpus_pipeline.STAGES:
        found.append(materialise(stage(spark, found[-1], sf_dir)))
    return found


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard_join", "substring_dedup", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns(steps):
    for df in steps[:-1]:
        assert df.columns == COLUMNS and [t for _, t in df.dtypes] == ["bigint", "string", "string", "string", "bigint"]


def test_documents_without_a_letter_go(steps):
    same(pairs(steps[1]), [(i, t) for i, t in pairs(steps[0]) if t and any(c.isalpha() for c in t)])


def test_texts_in_no_learned_language_go(spark, sf_dir):
    """Those of a length that enough rows were learned from; shorter ones, and all learned rows, stay."""
    from quarry.llm.language_id import LEAST_ROWS

    clean = [(i, " ".join(f"{a} {b} the house of {a}" for a in ("river", "mountain", "window")) + f" {b}", "en") for i, b in enumerate(["green", "winter", "morning", "letter"] * LEAST_ROWS)]
    other = [(1000, "你好世界这是一个没有学过的语言" * 8, None), (1001, "Αυτό είναι ένα κείμενο στα ελληνικά που δεν έχει μάθει κανείς " * 2, None), (1002, "你好", None), (1003, "12 34", None)]
    docs = spark.createDataFrame([(i, t, l, None, len(t)) for i, t, l in clean + other], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    same(pairs(corpus_pipeline.identify_language(spark, docs, sf_dir)), [(i, t) for i, t, _ in [*clean, other[2]]])


def test_documents_stay_if_no_language_is_learned(spark, sf_dir):
    docs = frame(spark, AWKWARD).withColumn("lang", F.lit(None).cast("string"))
    found = corpus_pipeline.identify_language(spark, docs, sf_dir)
    assert found.columns == COLUMNS
    same(pairs(found), [(i, t) for i, t in AWKWARD if t and any(c.isalpha() for c in t)])


def test_repeated_lines_go(steps):
    given = in_order(set(pairs(steps[1])))
    fate = {(i, t): left for (i, t), (_, left, _, _) in zip(given, lines_by_force(given))}
    same(pairs(steps[2]), [(i, fate[i, t]) for i, t in pairs(steps[1])])


def test_one_document_of_each_component_stays(steps):
    given = pairs(steps[2])
    gone = {i for i, _, c in components_by_force(given) if i is not None and i != c}
    same(pairs(steps[3]), [(i, t) for i, t in given if i not in gone])


def test_one_row_of_each_component_stays(spark, sf_dir):
    """Rows count, not ids: repeated rows, rows without an id, and other texts under the id of a copy."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a), (1, a), (1, a), (2, f"{a} x"), (2, b), (3, c), (3, f"{c} x"), (None, d), (None, f"{d} x"), (None, d), (None, f"{c} y"), (4, ""), (4, ""), (None, None), (None, None)]
    got = pairs(corpus_pipeline.drop_near_copies(spark, frame(spark, rows), sf_dir))
    ones = [[x for x in got if x in group] for group in ([(3, c), (3, f"{c} x")], [(None, d), (None, f"{d} x")])]
    assert [len(x) for x in ones] == [1, 1]
    same([x for x in got if x not in ones[0] + ones[1]], [(1, a), (2, b), (None, f"{c} y"), (4, ""), (4, ""), (None, None), (None, None)])


def test_repeated_passages_go(steps):
    given = in_order(pairs(steps[3]))
    same([(i, WORD.findall(t or "")) for i, t in pairs(steps[4])], [(i, w) for (i, _), (_, _, w) in zip(given, kept_by_force(given))])


def test_everything_is_packed(steps):
    rows = steps[5].collect()
    check_places(rows)
    assert {r.doc_id for r in rows} == {i for i, _ in pairs(steps[4])}
    assert sum(1 for r in rows if r.piece == 0) == steps[4].count()


def test_own_columns_stay(spark, sf_dir):
    docs = frame(spark, AWKWARD).withColumns({"Score": F.col("doc_id") * 2, "lang_pred": F.lit("mine"), "_given_Score": F.lit(1)})
    found = corpus_pipeline.identify_language(spark, docs, sf_dir)
    assert found.columns == docs.columns
    assert {(r["Score"], r["lang_pred"], r["_given_Score"]) for r in found.collect() if r.doc_id is not None} == {(i * 2, "mine", 1) for i, t in AWKWARD if i is not None and t and any(c.isalpha() for c in t)}


def test_run(spark, sf_dir):
    before = set(common._written)
    found = corpus_pipeline.run(spark, sf_dir)
    assert len(set(common._written) - before) == 2  # the last documents, and their pieces
    check_places(found.collect())
    assert set(found.columns) >= {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}


def test_empty(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_workers_give_back_what_groups_took(spark, sf_dir, monkeypatch):
    """Whatever runs in Python workers is lean; a worker that keeps its largest group's memory keeps it beside all that the JVM does later."""
    given = []

    def noted(owner, name):
        before = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda self, f, *a, **b: given.append((name, f)) or before(self, f, *a, **b))

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(50)
    noted(type(docs), "mapInArrow")
    noted(type(docs.groupBy("doc_id")), "applyInArrow")
    noted(PandasCogroupedOps, "applyInArrow")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir)
    assert {n for n, _ in given} == {"mapInArrow", "applyInArrow"} and len(given) >= 12
    assert [f.__qualname__ for n, f in given if not f.__qualname__.startswith("lean_batches." if n == "mapInArrow" else "lean.")] == []


def resident():
    return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) >> 10


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim") or not os.path.exists("/proc/self/status"), reason="another C library")
def test_freed_memory_goes_back():
    """200 MB of small arrays that are freed behind one that stays."""
    stay = []

    def fill(_):
        many = [np.ones(2000) for _ in range(13_000)]
        stay.append(np.ones(2000))
        return len(many)

    before = resident()
    assert common.lean(lambda t: fill(t))(pa.table({})) == 13_000
    assert resident() - before < 60
    assert list(common.lean_batches(lambda batches: (fill(b) for b in batches))(iter([1, 2]))) == [13_000, 13_000]
    assert resident() - before < 60
    fill(None)
    assert resident() - before > 60  # without, they stay
    common.give_back()


def test_results_and_errors_of_lean_functions():
    assert [common.lean(f)(*range(n)) for n, f in ((1, lambda a: a), (2, lambda a, b: (a, b)), (3, lambda a, b, c: (a, b, c)))] == [0, (0, 1), (0, 1, 2)]
    with pytest.raises(ZeroDivisionError):
        common.lean(lambda a: 1 / a)(0)
    with pytest.raises(ZeroDivisionError):
        list(common.lean_batches(lambda batches: (1 / b for b in batches))(iter([1, 0])))


def test_what_stages_write_is_read_in_short_batches(spark, sf_dir, monkeypatch):
    docs, given, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {k: spark.conf.get(k) for k in TEXT_ROWS}, []

    def noted(df):
        seen.append({k: int(spark.conf.get(k)) for k in TEXT_ROWS})
        return materialise(df)

    for module in ("corpus_pipeline", "quarry.llm.line_dedup", "quarry.llm.ngram_join"):
        monkeypatch.setattr(importlib.import_module(module), "materialise", noted)
    for _, stage in corpus_pipeline.STAGES[:3]:
        seen.clear()
        stage(spark, docs, sf_dir)
        assert seen and all(x == TEXT_ROWS for x in seen)
        assert {k: spark.conf.get(k) for k in TEXT_ROWS} == given
