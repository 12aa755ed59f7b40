"""Types, settings, tab-separated text, catalog and inserts."""

import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources import settings as S
from quarry.sources import sinks, tsv
from quarry.sources.catalog import Catalog
from quarry.sources.types import SIMPLE, TypeSyntaxError, parse_type, schema_of


@pytest.mark.parametrize(
    ("text", "kind", "nullable"),
    [
        ("Int8", T.ShortType(), False), ("UInt16", T.IntegerType(), False), ("UInt32", T.LongType(), False), ("UInt64", T.DecimalType(20, 0), False),
        ("Nullable(Float64)", T.DoubleType(), True), ("LowCardinality(Nullable(String))", T.StringType(), True), ("DateTime", T.TimestampNTZType(), False),
        ("DateTime('Europe/Berlin')", T.TimestampNTZType(), False), ("DateTime64(3, 'UTC')", T.TimestampNTZType(), False), ("Date", T.DateType(), False),
        ("Decimal(9, 4)", T.DecimalType(9, 4), False), ("Decimal64(6)", T.DecimalType(18, 6), False), ("Enum8('one' = 1, 'two' = 2)", T.StringType(), False),
        ("Array(Nullable(Int32))", T.ArrayType(T.IntegerType(), True), False), ("Array(Array(String))", T.ArrayType(T.ArrayType(T.StringType(), False), False), False),
        ("Map(String, UInt8)", T.MapType(T.StringType(), T.ShortType(), False), False), ("AggregateFunction(sum, Int32)", T.IntegerType(), False), ("AggregateFunction(count)", T.LongType(), False),
        ("AggregateFunction(quantile(0.5), Float64)".replace("0.5", "1"), T.DoubleType(), False), ("SimpleAggregateFunction(sum, Int64)", T.LongType(), False),
        ("AggregateFunction(sumMap, Array(Int32), Array(Int64))", T.MapType(T.IntegerType(), T.LongType(), True), False),
        ("Tuple(a Int32, b String)", T.StructType([T.StructField("a", T.IntegerType(), False), T.StructField("b", T.StringType(), False)]), False),
        ("Tuple(Int32, Nullable(String))", T.StructType([T.StructField("_1", T.IntegerType(), False), T.StructField("_2", T.StringType(), True)]), False),
    ],
)
def test_types(text, kind, nullable):
    found = parse_type(text)
    assert (found.spark, found.nullable) == (kind, nullable)


@pytest.mark.parametrize("text", ["", "Nope", "Nullable(Nullable(Int8))", "Decimal(5)", "Array(Int8", "Int8)", "Enum8('a')", "Int8 Int8", "Array()"])
def test_types_that_are_none(text):
    with pytest.raises((TypeSyntaxError, ValueError)):
        parse_type(text)


_simple = st.sampled_from(sorted(SIMPLE))
_types = st.recursive(_simple, lambda t: st.one_of(t.map(lambda x: f"Array({x})"), st.lists(t, min_size=1, max_size=3).map(lambda x: f"Tuple({', '.join(x)})")), max_leaves=6)


@given(_types, st.booleans())
def test_types_nest(text, blank):
    assert parse_type(text.replace("(", " ( ") if blank else text).spark == parse_type(text).spark


def test_schema_keeps_what_columns_remember():
    schema = schema_of([("a", "FixedString(4)"), ("b", "AggregateFunction(sum, Int64)"), ("c", "Nullable(Int8)")])
    assert [f.metadata for f in schema] == [{"fixed": 4}, {"agg_state": "sum"}, {}]
    assert [f.nullable for f in schema] == [False, False, True]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("", {}), ("  ", {}), ("a 1", {"a": "1"}), ("a 1, b 2", {"a": "1", "b": "2"}), ("a 1 , b 2", {"a": "1", "b": "2"}), ("a 'x, y'", {"a": "x, y"}),
        (r"a 'it\'s'", {"a": "it's"}), (r"a x\,y", {"a": "x,y"}), ("a 1, a 2", {"a": "2"}), ("a '' , b 'c'", {"a": "", "b": "c"}), (r"a \\", {"a": "\\"}),
        (S.DEFAULTS, {"join_use_nulls": "1", "group_by_use_nulls": "1", "final": "1"}),
    ],
)
def test_settings(text, found):
    assert S.parse(text) == found


@pytest.mark.parametrize("text", ["a", "a 1 b 2", "a 'x", "a 1,", "a, b 1", "a \\"])
def test_settings_that_cannot_be_read(text):
    with pytest.raises(S.SettingsError):
        S.parse(text)


@given(st.dictionaries(st.text("abc_", min_size=1), st.text(), max_size=4))
def test_settings_come_back(values):
    def quoted(v):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

    assert S.parse(", ".join(f"{k} {quoted(v)}" for k, v in values.items())) == values


def test_connections_options_and_ports():
    assert S.connection("host=localhost port=8123") == {"host": "localhost", "port": "8123"}
    with pytest.raises(S.SettingsError, match="valid ones are host"):
        S.connection("hots=x")
    with pytest.raises(S.SettingsError, match="server"):
        S.validated({"x": "1"}, S.SERVER_KEYS, "server")
    assert [S.default_port(d, h, (".cloud",)) for d in ("http", "binary") for h in ("a.cloud", "b")] == [8443, 8123, 9440, 9000]
    with pytest.raises(S.SettingsError):
        S.default_port("ftp")


def test_session_settings(spark):
    s = S.Session()
    assert s.final
    s.set("final 0, max_threads 4, other x")
    assert not s.final and s.spark_conf() == {"spark.sql.shuffle.partitions": "4"} and s.values["other"] == "x"
    s.apply(spark)
    s.reset()
    assert s.values["join_use_nulls"] == "1"


FIELDS = ["plain", "", "tab\there", "line\nbreak", "back\\slash", "quote'", "\b\f\r\0", "\\N", None, "\\", "ends\\", "é✓"]


def test_tsv_round_trip(spark, tmp_path):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("s", T.StringType())])
    rows = list(enumerate(FIELDS))
    tsv.write(spark.createDataFrame(rows, schema), str(tmp_path / "t"))
    assert sorted(map(tuple, tsv.read(spark, str(tmp_path / "t"), schema).collect())) == rows


def test_tsv_types(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("1\ttrue\t2020-01-02\t2020-01-02 03:04:05\t[1,2]\t\\N\t['a','it\\\\'s']\n0\t0\t0000-00-00\t0000-00-00 00:00:00\t[]\t1.5\t[]\n")
    schema = T.StructType([
        T.StructField("i", T.IntegerType()), T.StructField("b", T.BooleanType()), T.StructField("d", T.DateType()), T.StructField("t", T.TimestampNTZType()),
        T.StructField("a", T.ArrayType(T.IntegerType())), T.StructField("n", T.DecimalType(5, 2)), T.StructField("s", T.ArrayType(T.StringType())),
    ])
    one, two = sorted(tsv.read(spark, str(tmp_path / "x.tsv"), schema).collect(), key=lambda r: -r.i)
    assert (one.i, one.b, one.d, one.t, one.a, one.n, one.s[0]) == (1, True, dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5), [1, 2], None, "a")
    assert (two.b, two.d, two.t, two.a, float(two.n), two.s) == (False, None, None, [], 1.5, [])


def test_inserts(spark, tmp_path):
    at = str(tmp_path / "t")
    schema = T.StructType([T.StructField("c1", T.ShortType(), False), T.StructField("c2", T.IntegerType(), True)])
    sinks.insert(spark.sql("select 1 as c2, 2 as c1"), at, schema)
    sinks.insert(spark.sql("select 3 as c1"), at, schema)
    assert sorted(map(tuple, spark.read.parquet(at).select("c1", "c2").collect())) == [(2, 1), (3, None)]
    with pytest.raises(ValueError, match="c1 must be given"):
        sinks.insert(spark.sql("select 1 as c2"), at, schema)
    with pytest.raises(ValueError, match="doesn't have: x"):
        sinks.insert(spark.sql("select 1 as c1, 2 as x"), at, schema)
    with pytest.raises(PySparkException):
        sinks.insert(spark.sql("select cast(null as int) as c1"), at, schema)
    for refused in (sinks.update, sinks.delete):
        with pytest.raises(sinks.UnsupportedOperation):
            refused("t")
    (tmp_path / "in.tsv").write_text("7\t\\N\n")
    sinks.copy_from(spark, str(tmp_path / "in.tsv"), at, schema)
    assert spark.read.parquet(at).filter("c1 = 7").count() == 1


def test_catalog(spark, tmp_path, sf_dir):
    c = Catalog(spark)
    assert c.import_schema(sf_dir, limit_to=["region", "nation"], prefix="t_") == ["t_nation", "t_region"]
    assert "t_orders" in c.import_schema(sf_dir, except_=["region"], prefix="t_")
    with pytest.raises(ValueError):
        c.import_schema(sf_dir, limit_to=[], except_=[])
    assert c.table("t_region").count() == 5
    assert c.raw_query("select 1 as a, 'x\ty' as b, cast(null as int) as c") == "1\tx\\ty\t\\N"
    spark.sql("select 1L as remote, 'b' as s").write.parquet(str(tmp_path / "r"))
    assert c.create_table("renamed", str(tmp_path / "r"), [("k", "Int64"), ("s", "Nullable(String)")], column_name={"k": "remote"}, engine="CollapsingMergeTree(sgn)").collect() == [(1, "b")]
    assert c.tables["renamed"].collapsing is not None
    with pytest.raises(S.SettingsError):
        c.create_table("bad", str(tmp_path / "r"), [("k", "Int64")], engin="x")
    server = c.create_server("s", host="h")
    server.user_mapping("u", user="me", password="secret")
    assert server.options["port"] == "8123" and "secret" not in repr(server)
    assert c.analyze("t_region")["bytes"] > 0
    c.drop("t_region")
    assert "t_region" not in c.tables


def test_pushdown_report(spark, sf_dir):
    from quarry.plans.explain import report
    from quarry.plans.registry import queries

    r = report(queries()["tpch_q4"](spark, sf_dir))
    assert any("o_orderdate" in f for f in r.pushed_filters) and not r.python
    assert sorted(map(sorted, r.read_columns)) == [["l_orderkey", "l_shipdate"], ["o_orderdate", "o_orderkey", "o_orderpriority"]]
    assert len(r.joins) == 1
    lines = report(spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter(F.col("l_quantity") < 3).select("l_tax"))
    assert lines.exchanges == 0 and lines.read_columns == [["l_quantity", "l_tax"]]


def test_tsv_arrays_of_strings(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["it's", 'a"b', None, "NULL", ""]), (2, []), (3, None), (4, ["a,b", "\\", "x\ty\nz"])], "i int, a array<string>")
    tsv.write(rows, str(tmp_path / "t"))
    assert sorted(map(tuple, tsv.read(spark, str(tmp_path / "t"), rows.schema).collect())) == sorted(map(tuple, rows.collect()))
