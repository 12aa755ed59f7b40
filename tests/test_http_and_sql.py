"""The HTTP source against a small server in this process, SQL functions, and cancelling."""

import datetime as dt
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.errors import PySparkException

from quarry.functions import sql
from quarry.sources import http, jobs


@pytest.fixture
def server():
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = self.rfile.read(int(self.headers["Content-Length"])).decode()
            given = {k: v[0] for k, v in parse_qs(urlsplit(self.path).query).items()}
            seen.append((given, body, self.headers.get("X-User")))
            bad = "nope" in body
            self.send_response(500 if bad else 200)
            self.end_headers()
            if bad:
                self.wfile.write(b"no such table")
            elif "system.columns" in body:
                self.wfile.write(b"t\ti\tInt32\nt\ts\tNullable(String)\n.inner.v\tx\tInt8\nu\tk\tUInt8\n")
            elif "query" not in given:
                part = body[-1] if body[-1].isdigit() else "0"
                self.wfile.write(f"{part}\ta\\tb\t\\N\t2020-01-02 03:04:05\t[1,2]\n".encode())

        def log_message(self, *_):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/", seen
    s.shutdown()


SCHEMA = "i int, s string, n double, t timestamp_ntz, a array<int>"


def test_reads(spark, server):
    url, seen = server
    spark.dataSource.register(http.HttpSql)
    reader = spark.read.format("http_sql").schema(SCHEMA).option("url", url).option("user", "me")
    assert [tuple(r) for r in reader.option("query", "select x").load().collect()] == [(0, "a\tb", None, dt.datetime(2020, 1, 2, 3, 4, 5), [1, 2])]
    assert seen[-1][1:] == ("select x", "me") and seen[-1][0]["final"] == "1" and "query_id" in seen[-1][0]
    many = reader.option("query", "select {part}").option("partitions", "3").load()
    assert sorted(r.i for r in many.collect()) == [0, 1, 2]
    reader.option("table", "t").option("query", "").option("partitions", "1").load().collect()
    assert seen[-1][1] == "select i, s, n, t, a from t"
    with pytest.raises(PySparkException, match="no such table"):
        spark.read.format("http_sql").schema(SCHEMA).option("url", url).option("query", "nope").load().collect()
    with pytest.raises(PySparkException, match="invalid option"):
        spark.read.format("http_sql").schema(SCHEMA).option("url", url).option("wrong", "1").load().collect()


def test_inserts(spark, server):
    url, seen = server
    spark.dataSource.register(http.HttpSql)
    rows = spark.sql("select 1 as i, 'x\\ty' as s, cast(null as double) as n, true as b, array('p', 'q') as a").coalesce(1)
    rows.write.format("http_sql").option("url", url).option("table", "t").mode("append").save()
    assert seen[-1][0]["query"] == "INSERT INTO t (i, s, n, b, a) FORMAT TSV" and seen[-1][1] == "1\tx\\ty\t\\N\t1\t['p','q']\n"


def test_servers_of_the_catalog(spark, server):
    from quarry.sources.catalog import Catalog

    url, seen = server
    host, port = url.removeprefix("http://").rstrip("/").split(":")
    c = Catalog(spark)
    c.create_server("s", host=host, port=port).user_mapping("default", user="me", password="secret")
    client = c.connect("s")
    assert c.connect("s") is client
    c.session.set("max_rows '5'")
    found = c.remote_table("s", "t", [("i", "Int32"), ("s", "String"), ("n", "Nullable(Float64)"), ("t", "DateTime"), ("a", "Array(Int32)")])
    assert found.select("s").first().s == "a\tb"
    assert seen[-1][1] == "select i, s, n, t, a from t" and seen[-1][0]["max_rows"] == "5" and seen[-1][2] == "me"
    c.remote_insert(spark.sql("select 1 as i").coalesce(1), "s", "t")
    assert seen[-1][0]["query"] == "INSERT INTO t (i) FORMAT TSV"
    c.alter_server("s", host="localhost")
    assert c.connect("s") is not client and "localhost" in c.connect("s").options["url"]
    with pytest.raises(ValueError, match="user mapping"):
        c.alter_server("s", user="default", nope="x")


def test_conditions_limits_and_ranges_go_to_the_server(spark, server):
    from quarry.sources.catalog import Catalog

    url, seen = server
    host, port = url.removeprefix("http://").rstrip("/").split(":")
    c = Catalog(spark)
    c.create_server("s", host=host, port=port)
    columns = [("i", "Int32"), ("s", "String"), ("n", "Nullable(Float64)"), ("t", "DateTime"), ("a", "Array(Int32)")]
    found = c.remote_table("s", "t", columns, where="i < 5 or i > 10")
    assert found.count() == 1 and seen[-1][1] == "select i, s, n, t, a from t where (i < 5 or i > 10)"
    assert c.remote_table("s", "t", columns, query="select * from x", where="n > 1").count() == 1
    assert seen[-1][1] == "select i, s, n, t, a from (select * from x) as q where (n > 1)"
    assert c.remote_table("s", "t", columns, limit=1, split=("i", 0, 10, 2)).count() == 1 and seen[-1][1].endswith(" limit 1")
    before = len(seen)
    assert c.remote_table("s", "t", columns, split=("i", 0, 10, 3), where="i <> 4").count() == 3
    assert sorted(x[1].split(" where ")[1] for x in seen[before:]) == ["(i < 3 or i is null) and (i <> 4)", "i >= 3 and i < 6 and (i <> 4)", "i >= 6 and (i <> 4)"]


def test_queries_on_one_remote_table_do_not_see_each_others_filters(spark, server):
    from quarry.sources.catalog import Catalog

    url, seen = server
    host, port = url.removeprefix("http://").rstrip("/").split(":")
    c = Catalog(spark)
    c.create_server("s", host=host, port=port)
    found = c.remote_table("s", "t", [("i", "Int32"), ("s", "String"), ("n", "Nullable(Float64)"), ("t", "DateTime"), ("a", "Array(Int32)")])
    assert found.filter("i > 70").count() == 0 and found.count() == 1 and found.filter("i < 70").count() == 1
    assert {x[1] for x in seen} == {"select i, s, n, t, a from t"}
    assert http.quoted("it's \\") == r"'it\'s \\'"


def test_import_from_a_server(spark, server):
    from quarry.sources.catalog import Catalog, Server

    url, seen = server
    host, port = url.removeprefix("http://").rstrip("/").split(":")
    c = Catalog(spark)
    c.create_server("s", host=host, port=port)
    assert c.import_remote("s", "db", prefix="far_") == ["far_t", "far_u"] and "database = 'db'" in seen[-1][1]
    assert spark.table("far_t").dtypes == [("i", "int"), ("s", "string")]
    assert c.import_remote("s", "db", limit_to=["u"]) == ["u"] and c.import_remote("s", "db", except_=["u"], prefix="x_") == ["x_t"]
    with pytest.raises(ValueError, match="exclude"):
        c.import_remote("s", "db", limit_to=[], except_=[])
    assert Server("a", {"host": "x.cloud.example"}, cloud_suffixes=(".cloud.example",)).options["port"] == "8443"


def test_inserts_carry_a_token(spark, server):
    url, seen = server
    spark.dataSource.register(http.HttpSql)
    before = len(seen)
    spark.range(4).repartition(2).write.format("http_sql").option("url", url).option("table", "t").mode("append").save()
    tokens = [x[0]["insert_deduplication_token"] for x in seen[before:]]
    assert len(set(tokens)) == len(tokens) == 2 and len({x.split("-")[0] for x in tokens}) == 1


def test_retries_then_gives_up():
    client = http.Client({"url": "http://127.0.0.1:9/"})
    with pytest.raises(OSError):
        client.open("select 1")
    with pytest.raises(ValueError, match="url is missing"):
        http.Client({})


def test_sql_functions(spark):
    assert len(sql.register(spark)) == len(sql.FUNCTIONS)
    row = spark.sql("""select toUInt8('257') a, toUInt16(65535) b, toUInt64('-1') c, positionOf('abc', 'c') d, toDayOfWeek(timestamp_ntz'2026-11-22 00:00:00') e,
        toMonday(timestamp_ntz'2026-11-22 10:00:00') f, countEqual(array(1, 2, 1), 1) g, indexOf(array(1, 2), 2) h, match('val1', 'l[0-9]') i, has(array(1), 2) j""").first()
    assert (row.a, row.b, int(row.c), row.d, row.e) == (1, 65535, 2**64 - 1, 3, 7)
    assert (row.f, row.g, row.h, row.i, row.j) == (dt.datetime(2026, 11, 16), 2, 2, True, False)


def test_cancelling(spark):
    with jobs.cancellable(spark, "long one") as group:
        timer = threading.Timer(3, jobs.cancel, (spark, group))
        timer.start()
        with pytest.raises(Exception, match="cancelled"):
            spark.range(10**15).selectExpr("sum(hash(id) % 7)").collect()
        timer.cancel()
    assert spark.range(5).count() == 5


def test_dialect_in_text():
    from quarry.functions.dialect import translate

    assert translate("select sumIf(x, y > 1) from t") == "select sum(x) filter (where y > 1) from t"
    assert translate("select 'argMin(a, b)', f(ARGMIN(a, g(b, c))) -- uniq(x)\nfrom t") == "select 'argMin(a, b)', f(min_by(a, g(b, c))) -- uniq(x)\nfrom t"
    assert translate("select quantile(0.9)(x), quantile(x) from t") == "select percentile(x, 0.9D), percentile(x, 0.5D) from t"
    assert translate("select sumMerge(s), t.sum(x) from t") == "select sum(s.sum), t.sum(x) from t"
    with pytest.raises(ValueError, match="no dictionary"):
        translate("select dictGet('none', 'a', 1)")
    with pytest.raises(ValueError, match="not closed"):
        translate("select sum(x")


def test_tables_act_on_statements(spark):
    """A collapsing table that is read alone counts by signs; a column of states is merged; with other tables nothing is assumed."""
    from quarry.functions.dialect import translate
    from quarry.sources.catalog import Table
    from quarry.sources.types import schema_of

    tables = {
        "c": Table("c", "", schema_of([("v", "Int32"), ("s", "Int8")]), {"engine": "CollapsingMergeTree(s)"}),
        "m": Table("m", "", schema_of([("b", "AggregateFunction(sum, Int32)"), ("e", "AggregateFunction(count)")]), {}),
    }
    spark.sql("select * from values (1, 1), (1, -1), (5, 1), (null, 1) as c(v, s)").createOrReplaceTempView("c")
    assert tuple(spark.sql(translate("select sum(v), count(*), count(v), avg(v), max(v), count(distinct v), sum(v) filter (where v > 1) from c", tables)).first()) == (5, 2, 1, 5.0, 5, 2, 5)
    assert translate("select count(*) from c join m on c.v = m.b", tables) == "select count(*) from c join m on c.v = m.b"
    assert translate("select sumMerge(b), countMerge(e), count(e), count(*) from m", tables) == "select sum(b), coalesce(sum(e), 0L), coalesce(sum(e), 0L), count(*) from m"


def test_composite_dictionary_in_text(spark):
    from quarry.sources.catalog import Catalog

    catalog = Catalog(spark)
    catalog.create_dictionary("pairs", spark.sql("select * from values (1, 'k', 'v'), (2, 'l', null) as p(a, b, c)"), "a", "b")
    found = catalog.sql("select dictGet('pairs', 'c', (x, y)) as c from values (1, 'k'), (2, 'l'), (3, 'm') as q(x, y) order by x").collect()
    assert [r.c for r in found] == ["v", None, ""]


def test_array_text_over_http():
    from pyspark.sql import types as T

    text = http._parser(T.ArrayType(T.StringType()))
    for value in (["it's"], ['a"b'], ["a,b", "[c]", ""], [None, "NULL", "\\", "x\ty\nz"], [], ["\\q"]):
        assert text(http._escaped(value)) == value
    assert http._parser(T.ArrayType(T.LongType()))("[1, -2,NULL]") == [1, -2, None]
    assert http._parser(T.ArrayType(T.ArrayType(T.StringType())))("[['a','b]'],[],['it\\'s']]") == [["a", "b]"], [], ["it's"]]
    assert http._unescaped(r"a\xb\tc") == "a\\xb\tc"


def test_starts_of_units_do_not_follow_the_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        sql.register(spark)
        row = spark.sql("""select cast(toStartOfHour(t) as string), cast(toStartOfMinute(t) as string), cast(toStartOfDay(t) as string), cast(toStartOfQuarter(t) as string), toUnixTimestamp(t)
            from values (timestamp_ntz'2024-03-10 02:30:40') as x(t)""").first()
        assert tuple(row) == ("2024-03-10 02:00:00", "2024-03-10 02:30:00", "2024-03-10 00:00:00", "2024-01-01 00:00:00", 1710037840)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
