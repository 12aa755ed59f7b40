"""Golden values of the dialect's functions, aggregates and table semantics on small fixtures."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarry.functions import scalars as S
from quarry.operators import aggregates as A
from quarry.operators import engines as E
from quarry.operators import joins as J
from quarry.operators import maps as M
from quarry.operators.dictionary import Dictionary


@pytest.fixture(scope="module")
def four(spark):
    rows = [(1, 1, "2019-01-01 10:00:00"), (2, 2, "2019-01-02 10:00:00"), (2, 2, "2019-01-02 11:00:00"), (2, 3, "2019-01-02 10:00:00")]
    return spark.createDataFrame(rows, "a int, b int, c string").withColumn("c", F.col("c").cast("timestamp_ntz"))


def one(df, *columns):
    (row,) = df.agg(*columns).collect()
    return tuple(row)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_aggregates(four):
    assert one(four, A.arg_min(F.col("a"), F.col("b")), A.arg_max(F.col("a"), F.col("b"))) == (1, 2)
    assert one(four, A.uniq_exact(F.col("a")), A.uniq_exact_if(F.col("b") > 1, F.col("a")), A.uniq_exact(F.col("a"), F.col("b"))) == (2, 1, 3)
    assert one(four, A.quantile(F.col("a"), 0.25), A.percentile_cont(F.col("a"), 0.25), A.quantile_exact("a", 0.75), A.quantile_exact("a", 0.5), A.quantile(F.col("a"))) == (1.75, 1.75, 2.0, 2.0, 2.0)
    assert one(four, A.percentile_cont(F.unix_timestamp("c"), 0.95)) == (1546426260.0,)
    assert one(four, A.when_true(lambda x: A.percentile_cont(x, 0.25), F.col("b") == 1, F.col("a")), A.quantile_exact("a", 0.5, "b = 1")) == (1.0, 1.0)
    assert one(four, A.uniq(F.col("a")), A.uniq_combined(F.col("a")), A.uniq_combined64(F.col("b")), A.uniq_hll12(F.col("a"), F.col("b")), A.uniq_theta(F.col("b")), A.quantile_approx(F.col("a"))) == (2, 2, 3, 3, 3, 2)
    with pytest.raises(ValueError):
        A.percentile_cont(F.col("a"), 0.5, descending=True)


def test_aggregates_of_nothing_and_nulls(four):
    none = four.filter("a > 9")
    assert one(none, A.arg_min(F.col("a"), F.col("b")), A.uniq_exact(F.col("a")), A.quantile(F.col("a")), A.uniq_theta(F.col("a"))) == (None, 0, None, 0)
    nulls = four.withColumn("a", F.nullif(F.col("a"), F.lit(2)))
    assert one(nulls, A.uniq(F.col("a")), A.uniq_exact(F.col("a")), A.uniq_exact(F.col("a"), F.col("b"))) == (1, 1, 3)


@pytest.mark.parametrize(("kind", "want"), [("sum", 7), ("count", 4), ("min", 1), ("max", 2), ("avg", 1.75), ("uniq", 2), ("uniqHLL12", 2), ("quantile", 2.0)])
def test_states_merge(four, kind, want):
    states = four.groupBy("b").agg(*A.state(kind, "x", F.col("a")))
    assert one(states, A.merge(kind, "x"))[0] == want


def test_unknown_states():
    for f in (lambda: A.state("nope", "x", F.col("a")), lambda: A.merge("nope", "x")):
        with pytest.raises(ValueError, match="no mergeable state"):
            f()


def test_collapsing(spark):
    rows = [(1, 10, 1), (1, 10, -1), (1, 20, 1), (2, None, 1), (2, 5, 1), (2, 5, -1)]
    t = spark.createDataFrame(rows, "k int, v int, s int")
    c = E.Collapsing.parse("CollapsingMergeTree(s)")
    found = t.groupBy("k").agg(c.sum(F.col("v")), c.count(), c.count(F.col("v")), c.avg(F.col("v")), c.count(condition=F.col("v") > 15)).collect()
    assert sorted(map(tuple, found)) == [(1, 20, 1, 1, 20.0, 1), (2, 0, 1, 0, None, 0)]
    assert sorted(map(tuple, E.final_collapsing(t, ["k"], "s").collect())) == [(1, 20, 1), (2, None, 1)]
    later = spark.createDataFrame([(2, "z", 1, 1), (2, "y", -1, 2), (2, "y2", 1, 3), (3, "a", 1, 1), (3, "b", -1, 2)], "k int, v string, s int, o int")
    assert [tuple(r) for r in E.final_collapsing(later, ["k"], "s", ["o"]).collect()] == [(2, "y2", 1, 3)]
    assert E.Collapsing.parse("CollapsingMergeTree").sign is not None
    with pytest.raises(ValueError):
        E.Collapsing.parse("MergeTree")
    assert one(t.filter("k > 9"), c.count(), c.sum(F.col("v"))) == (0, None)


def test_replacing(spark):
    t = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 1, "b")], "k int, ver int, v string")
    assert sorted(map(tuple, E.final_replacing(t, ["k"], ["ver"]).collect())) == [(1, 2, None), (2, 1, "b")]


def test_dates(spark):
    stamps = ["2025-10-15 20:12:25", "2026-11-17 08:13:26", "2027-12-17 22:14:27", "2028-01-18 23:15:28", "2029-02-19 01:16:29", "2030-03-20 02:16:30"]
    t = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    assert t.filter(S.date_part("dow", F.col("ts")) == 2).count() == 2
    assert [r.ts for r in t.filter(S.date_part("week", F.col("ts")) == 47).collect()] == [dt.datetime(2026, 11, 17, 8, 13, 26)]
    week = t.select(S.date_trunc("week", F.col("ts")).alias("w")).first().w
    assert week == dt.datetime(2025, 10, 13)
    for f in (S.date_trunc, S.date_part):
        with pytest.raises(ValueError):
            f("century", F.col("ts"))
    day = F.lit("2020-01-31 00:00:00").cast("timestamp_ntz")
    assert value(spark, S.add_interval(day, months=1, days=1, seconds=1.5)) == dt.datetime(2020, 3, 1, 0, 0, 1, 500000)
    assert value(spark, S.day_diff(day, F.lit("2020-01-29 12:00:00").cast("timestamp_ntz"))) == -1


def test_wall_times_do_not_follow_the_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = F.lit("2024-03-10 02:30:00.5").cast("timestamp_ntz")
        assert value(spark, S.date_part("epoch", ts)) == 1710037800
        assert value(spark, S.date_part("epoch", F.lit("1969-12-31 23:59:59.5").cast("timestamp_ntz"))) == -1
        assert value(spark, S.date_trunc("hour", ts)) == dt.datetime(2024, 3, 10, 2)
        assert value(spark, S.day_diff(F.lit("2024-03-09 12:00:00").cast("timestamp_ntz"), F.lit("2024-03-10 12:00:00").cast("timestamp_ntz"))) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_numbers_arrays_and_casts(spark):
    items, lit = F.array(F.lit(3), F.lit(5), F.lit(3)), F.lit
    for column, want in [
        (S.int_div(lit(-7), lit(2)), -3), (S.int_div(lit(9007199254740993), lit(1)), 9007199254740993), (S.int_div(lit(1), lit(0)), None), (S.subscript(items, 2), 5), (S.subscript(items, 0), None), (S.subscript(items, 9), None), (S.subarray(items, 2, 3), [5, 3]),
        (S.index_of(items, lit(5)), 2), (S.index_of(items, lit(9)), None), (S.count_equal(items, lit(3)), 2), (S.any_of(lit(3), items), True), (S.ne_any(lit(3), items), True),
        (S.eq_all(lit(3), items), False), (S.ne_all(lit(4), items), True), (S.to_uint(lit(-1), 8), 255), (S.to_uint(lit(65535), 16), 65535), (S.to_uint(lit("70000"), 32), 70000),
        (S.strpos(lit("abcb"), "b"), 2), (S.match(lit("val1"), "^val[0-9]"), True),
    ]:
        assert value(spark, column) == want
    assert int(value(spark, S.to_uint(lit(-1), 64))) == 2**64 - 1
    assert int(value(spark, S.to_uint(lit("12345678901234567890123456789012345678"), 128))) == 12345678901234567890123456789012345678
    with pytest.raises(PySparkException):
        value(spark, S.to_uint(lit(256), 8, "error"))
    with pytest.raises(ValueError):
        S.to_uint(lit(1), 7)


def test_maps(spark):
    m = F.create_map(F.lit(1), F.lit(10).cast("bigint"), F.lit(4), F.lit(5).cast("bigint"))
    assert value(spark, S.map_fetch(m, F.lit(4))) == 5 and value(spark, S.map_fetch(m, F.lit(2))) is None
    assert value(spark, S.map_sum_up(m)) == 15 and value(spark, S.map_sum_up(m, F.lit(3))) == 10
    assert value(spark, S.map_seed(0, 2, F.lit(7))) == {0: 7, 1: 7, 2: 7}
    assert value(spark, S.map_accumulate(m, F.lit(5))) == {1: 10, 2: 10, 3: 10, 4: 15, 5: 15}
    two = spark.createDataFrame([(1, [1, 2, 1], [5, 6, 7]), (1, [2], [4]), (2, [], [])], "g int, k array<int>, v array<bigint>")
    merged = M.sum_map(M.from_arrays(two, "m", "k", "v"), ["g"], "m")
    assert sorted(map(tuple, merged.collect())) == [(1, 1, 12), (1, 2, 10)]
    assert M.collect_map(merged, ["g"], "m").first().m == {1: 12, 2: 10}


def test_dictionary(spark):
    rows = [(i, f"key{i}", f"val{i}") for i in range(1, 4)]
    d = Dictionary(spark.createDataFrame(rows, "key1 int, key2 string, val string"), ("key1", "key2"))
    asked = spark.createDataFrame([(1, "key1"), (2, "x"), (None, "key1")], "a int, b string")
    found = d.get(asked, "val", [F.col("a"), F.col("b")], "v")
    assert sorted(((r.a, r.v) for r in found.collect()), key=repr) == [(1, "val1"), (2, ""), (None, "")]
    with pytest.raises(ValueError):
        d.get(asked, "val", [F.col("a")], "v")


def test_asof_and_range_joins(spark):
    left = spark.createDataFrame([("x", 5, 1), ("x", 1, 2), ("y", 9, 3)], "k string, t int, id int")
    right = spark.createDataFrame([("x", 2, "a"), ("x", 5, "b"), ("x", 5, "c"), ("x", 6, "d")], "k string, t int, v string")
    assert sorted(map(tuple, J.asof_join(left, right, ["k"], "t", ["v"]).select("id", "v").collect())) == [(1, "c"), (2, None), (3, None)]
    spans = spark.createDataFrame([(0, 10, "p"), (8, 31, "q"), (40, 41, "r")], "lo int, hi int, n string")
    points = spark.createDataFrame([(9,), (10,), (30,), (31,), (40,)], "at int")
    pairs = J.range_join(points, spans, "at", "lo", "hi", 10)
    assert sorted((r.at, r.n) for r in pairs.collect()) == [(9, "p"), (9, "q"), (10, "q"), (30, "q"), (40, "r")]


def test_streaming_windows(spark, sf_dir, tmp_path):
    from quarry.streaming import windows as W

    batch = spark.read.parquet(f"{sf_dir}/events.parquet")
    (tmp_path / "in").mkdir()
    batch.repartition(2).write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = W.read_files(spark, str(tmp_path / "in"), batch.schema, 1)
    counted = W.tumbling(stream, "ts", "1 day", ["event_type"], [F.count("*").alias("n")], "90 days")
    query = counted.writeStream.format("memory").queryName("days").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    want = W.tumbling(batch, "ts", "1 day", ["event_type"], [F.count("*").alias("n")])
    found = spark.table("days").select(*[F.col(c).cast("timestamp_ntz") for c in ("start", "end")], "event_type", "n")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert W.distinct_within(batch, "ts", ["user_id"], "1 day").count() == batch.select("user_id").distinct().count()
    assert W.session(batch, "ts", "1 hour", ["user_id"], [F.count("*").alias("n")]).agg(F.sum("n")).first()[0] == batch.count()


@pytest.mark.parametrize("accuracy", [10, 20_000])
def test_exact_quantiles_of_large_groups(spark, accuracy):
    import numpy as np

    from quarry.operators.quantiles import exact_quantile

    rng = np.random.default_rng(0)
    rows = [(None if g == 2 else g, float(x) if rng.random() > 0.1 else None) for g, n in ((0, 700), (1, 3), (2, 50)) for x in rng.integers(0, 300, n)]
    t = spark.createDataFrame(rows, "g int, x double")
    for p in (0.0, 0.9):
        want = {r.g: (r.a, r.b) for r in t.groupBy("g").agg(F.percentile("x", F.lit(p)).alias("a"), A.quantile_exact("x", p).alias("b")).collect()}
        for i, interpolate in enumerate((True, False)):
            found = exact_quantile(t, ["g"], F.col("x"), p, "q", interpolate, accuracy).collect()
            assert {r.g: round(r.q, 9) for r in found} == {g: round(v[i], 9) for g, v in want.items()}, (p, interpolate)
    assert exact_quantile(t, [], F.col("x"), 0.5).first().q == t.agg(F.percentile("x", F.lit(0.5))).first()[0]


def test_sketches_stay_within_their_errors(spark):
    t = spark.range(200_000).select((F.col("id") % 50_000).alias("x"))
    n, c, c64, h, th, q = t.agg(A.uniq(F.col("x")), A.uniq_combined(F.col("x")), A.uniq_combined64(F.col("x")), A.uniq_hll12(F.col("x")), A.uniq_theta(F.col("x")), A.quantile_approx(F.col("x"), 0.3)).first()
    for found, error in ((n, 0.04), (c, 0.03), (c64, 0.01), (h, 0.08), (th, 0.08), (q / 0.3, 0.001)):
        assert abs(found - 50_000) <= error * 50_000
    states = t.groupBy((F.col("x") % 7).alias("k")).agg(*A.state("quantile", "s", F.col("x")))
    assert abs(states.agg(A.merge("quantile", "s", 0.9)).first()[0] - 45_000) <= 0.03 * 50_000
