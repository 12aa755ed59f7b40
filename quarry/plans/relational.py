"""Scans, filters, joins, sorts, limits, set operations and subqueries."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import functions as F

from quarry.functions import scalars as S
from quarry.plans.registry import query
from quarry.plans.tables import day, money, t



def _shared(spark) -> str:
    """The folder that driver and executors share; a temporary one only where all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or f"file://{tempfile.mkdtemp(prefix='quarry-insert-')}").rstrip("/")


# scans and projections


@query("select o_orderkey, o_custkey, o_orderstatus from orders")
def scan_project(spark, d):
    return t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("select cast(null as int) as n from region")
def scan_no_columns(spark, d):
    return t(spark, d, "region").select(F.lit(None).cast("int").alias("n"))


@query("select cast(r.r_regionkey as varchar) || '|' || r.r_name as r from region r")
def whole_row_struct(spark, d):
    whole = t(spark, d, "region").select(F.struct("*").alias("row"))
    return whole.select(F.concat_ws("|", F.col("row.r_regionkey").cast("string"), "row.r_name").alias("r"))


@query("""select * from (values ('r_regionkey', 'int', true), ('r_name', 'string', true)) v(column_name, type, nullable)""")
def import_schema_describe(spark, d):
    from quarry.sources.catalog import Catalog

    catalog = Catalog(spark)
    catalog.import_schema(d, limit_to=["region"], prefix="imported_")
    return catalog.describe("imported_region")


@query("select r_regionkey, r_name from region")
def insert_roundtrip(spark, d):
    from quarry.sources.sinks import insert

    at = _shared(spark) + "/insert_roundtrip"
    rows = t(spark, d, "region")
    insert(rows.select("r_name", "r_regionkey"), at, rows.schema, overwrite=True)
    return spark.read.schema(rows.schema).parquet(at)


@query("select l_orderkey * 2 + l_linenumber as k, -l_linenumber as neg, l_quantity > 25 as big from lineitem")
def project_expr(spark, d):
    return t(spark, d, "lineitem").select((F.col("l_orderkey") * 2 + F.col("l_linenumber")).alias("k"), (-F.col("l_linenumber")).alias("neg"), (F.col("l_quantity") > 25).alias("big"))


@query("select 'fixed' as a, cast(null as varchar) as b, n_nationkey from nation")
def project_constants(spark, d):
    return t(spark, d, "nation").select(F.lit("fixed").alias("a"), F.lit(None).cast("string").alias("b"), "n_nationkey")


@query("select o_orderkey as id, o_orderstatus as st from orders where o_orderstatus <> 'P'")
def project_rename(spark, d):
    return t(spark, d, "orders").withColumnsRenamed({"o_orderkey": "id", "o_orderstatus": "st"}).filter("st <> 'P'").select("id", "st")


@query("select p_partkey, 'part' as tableoid from part")
def system_column(spark, d):
    return t(spark, d, "part").select("p_partkey", F.lit("part").alias("tableoid"))


# filters


def _lines(where: str) -> str:
    return f"select l_orderkey, l_linenumber, l_quantity from lineitem where {where}"


def _filter(name: str, where: str, condition, table: str = "lineitem", columns: tuple[str, ...] = ("l_orderkey", "l_linenumber", "l_quantity")):
    query(f"select {', '.join(columns)} from {table} where {where}", name)(lambda spark, d: t(spark, d, table).filter(condition()).select(*columns))


_O, _P, _C = ("o_orderkey", "o_orderstatus", "o_orderpriority"), ("p_partkey", "p_name", "p_size"), ("c_custkey", "c_mktsegment")
_filter("filter_and", "l_quantity < 10 and l_discount > 0.05", lambda: (F.col("l_quantity") < 10) & (F.col("l_discount") > 0.05))
_filter("filter_false", "1 = 0", lambda: F.lit(False))
_filter("filter_compare", "l_quantity <> 5 and l_linenumber >= 3 and l_extendedprice <= 30000", lambda: (F.col("l_quantity") != 5) & (F.col("l_linenumber") >= 3) & (F.col("l_extendedprice") <= 30000))
_filter("filter_unary_minus", "l_linenumber = - (-3)", lambda: -F.col("l_linenumber") == -3)
_filter("filter_bool", "not (l_quantity < 20 or l_tax > 0.04)", lambda: ~((F.col("l_quantity") < 20) | (F.col("l_tax") > 0.04)))
_filter("filter_null", "nullif(l_linenumber, 2) is null and nullif(l_returnflag, 'A') is not null", lambda: F.nullif(F.col("l_linenumber"), F.lit(2)).isNull() & F.nullif(F.col("l_returnflag"), F.lit("A")).isNotNull())
_filter("filter_not_null_column", "l_orderkey is null", lambda: F.col("l_orderkey").isNull())
_filter("filter_distinct_from", "nullif(l_linenumber, 2) is distinct from 3 and nullif(l_linenumber, 1) is not distinct from null", lambda: ~F.nullif(F.col("l_linenumber"), F.lit(2)).eqNullSafe(3) & F.nullif(F.col("l_linenumber"), F.lit(1)).eqNullSafe(None))
_filter("filter_in", "p_size in (1, 7, 49)", lambda: F.col("p_size").isin(1, 7, 49), "part", _P)
_filter("filter_not_in", "p_size not in (1, 2, 3)", lambda: ~F.col("p_size").isin(1, 2, 3), "part", _P)
_filter("filter_any_array", "list_contains([1, cast(p_partkey % 50 as int), 7], p_size)", lambda: S.any_of(F.col("p_size"), F.array(F.lit(1), (F.col("p_partkey") % 50).cast("int"), F.lit(7))), "part", _P)
_filter("filter_ne_any", "p_size <> p_size or p_size <> 1", lambda: S.ne_any(F.col("p_size"), F.array("p_size", F.lit(1))), "part", _P)
_filter("filter_eq_all", "p_size = p_size and p_size = 1", lambda: S.eq_all(F.col("p_size"), F.array("p_size", F.lit(1))), "part", _P)
_filter("filter_ne_all", "p_size <> 1 and p_size <> p_partkey % 50", lambda: S.ne_all(F.col("p_size"), F.array(F.lit(1), (F.col("p_partkey") % 50).cast("int"))), "part", _P)
_filter("filter_gt_any", "p_size > 10 or p_size > p_partkey % 50", lambda: F.exists(F.array(F.lit(10), (F.col("p_partkey") % 50).cast("int")), lambda i: F.col("p_size") > i), "part", _P)
_filter("filter_like", "p_name like '%ring%'", lambda: F.col("p_name").like("%ring%"), "part", _P)
_filter("filter_not_like", "p_name not like 'a%'", lambda: ~F.col("p_name").like("a%"), "part", _P)
_filter("filter_ilike", "c_mktsegment ilike 'build%' or c_mktsegment not ilike '%e%'", lambda: F.col("c_mktsegment").ilike("build%") | ~F.col("c_mktsegment").ilike("%e%"), "customer", _C)
_filter("filter_regexp", "regexp_matches(o_orderpriority, '^[12]-')", lambda: S.match(F.col("o_orderpriority"), "^[12]-"), "orders", _O)
_filter("filter_between", "l_quantity between 10 and 12", lambda: F.col("l_quantity").between(10, 12))
_filter("filter_date_range", "o_orderdate >= timestamp '1997-01-31' + interval 1 month and o_orderdate < timestamp '1998-01-01'", lambda: (F.col("o_orderdate") >= S.add_interval(day("1997-01-31"), months=1)) & (F.col("o_orderdate") < day("1998-01-01")), "orders", _O)


@query("select o_orderkey, o_orderstatus from orders where o_totalprice < 50000 and o_orderstatus = 'F'")
def filter_parameters(spark, d):
    return spark.sql("select o_orderkey, o_orderstatus from {orders} where o_totalprice < :most and o_orderstatus = :st", args={"most": 50000, "st": "F"}, orders=t(spark, d, "orders"))


# joins


@query("select o_orderkey, c_name from orders join customer on o_custkey = c_custkey where c_acctbal > 0")
def join_inner(spark, d):
    return t(spark, d, "orders").join(t(spark, d, "customer").filter("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("select c_custkey, o_orderkey from customer left join orders on o_custkey = c_custkey and o_orderdate >= timestamp '2001-01-01'")
def join_left(spark, d):
    late = t(spark, d, "orders").filter(F.col("o_orderdate") >= day("2001-01-01"))
    return t(spark, d, "customer").join(late, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey")


@query("select s_suppkey, n_name from supplier right join nation on s_nationkey = n_nationkey and s_acctbal > 5000")
def join_right(spark, d):
    return t(spark, d, "supplier").filter("s_acctbal > 5000").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "right").select("s_suppkey", "n_name")


@query("""select ck, sk, nc, ns from (select c_nationkey as ck, count(*) as nc from customer group by 1) c
full join (select s_nationkey + 5 as sk, count(*) as ns from supplier where s_acctbal > 0 group by 1) s on ck = sk""")
def join_full(spark, d):
    c = t(spark, d, "customer").groupBy(F.col("c_nationkey").alias("ck")).agg(F.count("*").alias("nc"))
    s = t(spark, d, "supplier").filter("s_acctbal > 0").groupBy((F.col("s_nationkey") + 5).alias("sk")).agg(F.count("*").alias("ns"))
    return c.join(s, F.col("ck") == F.col("sk"), "full")


@query("select o_orderkey, o_orderpriority from orders o where exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_quantity > 49)")
def join_semi_exists(spark, d):
    big = t(spark, d, "lineitem").filter("l_quantity > 49")
    return t(spark, d, "orders").join(big, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey", "o_orderpriority")


@query("select c_custkey, c_name from customer where c_nationkey in (select n_nationkey from nation where n_regionkey = 1)")
def join_in_subquery(spark, d):
    some = t(spark, d, "nation").filter("n_regionkey = 1")
    return t(spark, d, "customer").join(some, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey", "c_name")


@query("select r_name from region where exists (select 1 from nation where n_regionkey = 99) or not exists (select 1 from nation where n_regionkey = 99)")
def exists_uncorrelated(spark, d):
    none = t(spark, d, "nation").filter("n_regionkey = 99")
    return t(spark, d, "region").filter(none.exists() | ~none.exists()).select("r_name")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderdate >= timestamp '2001-01-01')")
def join_anti(spark, d):
    late = t(spark, d, "orders").filter(F.col("o_orderdate") >= day("2001-01-01"))
    return t(spark, d, "customer").join(late, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("select n_nationkey from nation where n_nationkey not in (select nullif(s_nationkey, -1) from supplier where s_acctbal > 9000)")
def join_not_in(spark, d):
    t(spark, d, "nation").createOrReplaceTempView("quarry_nation")
    t(spark, d, "supplier").createOrReplaceTempView("quarry_supplier")
    return spark.sql("select n_nationkey from quarry_nation where n_nationkey not in (select nullif(s_nationkey, -1) from quarry_supplier where s_acctbal > 9000)")


@query("select r_name, n_name from region cross join nation")
def join_cross(spark, d):
    return t(spark, d, "region").crossJoin(t(spark, d, "nation")).select("r_name", "n_name")


@query("select a.n_nationkey as a, b.n_nationkey as b from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey")
def join_theta(spark, d):
    a, b = t(spark, d, "nation").alias("a"), t(spark, d, "nation").alias("b")
    on = (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))
    return a.join(b, on).select(F.col("a.n_nationkey").alias("a"), F.col("b.n_nationkey").alias("b"))


@query("""select r_name, o_orderstatus, count(*) as n from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey group by all""")
def join_multiway(spark, d):
    places = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = t(spark, d, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return t(spark, d, "orders").join(people, F.col("o_custkey") == F.col("c_custkey")).groupBy("r_name", "o_orderstatus").agg(F.count("*").alias("n"))


@query("select s_suppkey, n_name from supplier join nation on cast(s_nationkey as bigint) = cast(n_nationkey as varchar)::bigint")
def join_on_cast(spark, d):
    on = F.col("s_nationkey").cast("bigint") == F.col("n_nationkey").cast("string").cast("bigint")
    return t(spark, d, "supplier").join(t(spark, d, "nation"), on).select("s_suppkey", "n_name")


@query("select a.l_orderkey as l_orderkey, a.l_linenumber as a, b.l_linenumber as b from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and a.l_linenumber < b.l_linenumber where a.l_suppkey = b.l_suppkey")
def join_self(spark, d):
    """Pairs of lines of one order by the same supplier: a key of a few rows each, so pairs grow with the lines."""
    a, b = t(spark, d, "lineitem").alias("a"), t(spark, d, "lineitem").alias("b")
    on = (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("a.l_suppkey") == F.col("b.l_suppkey")) & (F.col("a.l_linenumber") < F.col("b.l_linenumber"))
    return a.join(b, on).select(F.col("a.l_orderkey").alias("l_orderkey"), F.col("a.l_linenumber").alias("a"), F.col("b.l_linenumber").alias("b"))


@query("""with o as (select o_custkey, count(*) as n from orders group by 1) select c_mktsegment, cast(sum(n) as bigint) as n from customer join o on c_custkey = o_custkey group by 1""")
def cte_join(spark, d):
    counted = t(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return t(spark, d, "customer").join(counted, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_mktsegment").agg(F.sum("n").alias("n"))


@query("select o_orderkey, o_totalprice from orders where o_totalprice = (select max(o_totalprice) from orders)")
def scalar_subquery(spark, d):
    orders = t(spark, d, "orders")
    return orders.filter(F.col("o_totalprice") == orders.agg(F.max("o_totalprice")).scalar()).select("o_orderkey", "o_totalprice")


@query("select p_partkey from part p where p_size = (select max(p_size) from part q where q.p_brand = p.p_brand)")
def scalar_subquery_correlated(spark, d):
    part = t(spark, d, "part")
    most = part.groupBy("p_brand").agg(F.max("p_size").alias("m"))
    return part.join(most, "p_brand").filter("p_size = m").select("p_partkey")


@query("select k, n from (select l_orderkey % 7 as k, count(*) as n from (select l_orderkey from lineitem where l_quantity > 10) s group by 1) u where n > 10")
def from_subquery(spark, d):
    inner = t(spark, d, "lineitem").filter("l_quantity > 10").select("l_orderkey")
    return inner.groupBy((F.col("l_orderkey") % 7).alias("k")).agg(F.count("*").alias("n")).filter("n > 10")


# sorts and limits; a limited result is pinned by a total order


@query("select o_orderkey, nullif(o_orderstatus, 'P') as s from orders order by s nulls first, o_orderkey desc")
def sort_nulls(spark, d):
    return t(spark, d, "orders").select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("s")).orderBy(F.col("s").asc_nulls_first(), F.col("o_orderkey").desc())


@query("select p_brand, count(*) as n from part group by 1 order by n desc, p_brand")
def sort_after_agg(spark, d):
    return t(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "p_brand")


@query("select o_orderkey, o_custkey from orders order by o_orderkey limit 20 offset 100")
def limit_offset(spark, d):
    return t(spark, d, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey").offset(100).limit(20)


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def topk(spark, d):
    return t(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


# set operations


def _nations(spark, d):
    return t(spark, d, "customer").select(F.col("c_nationkey").alias("k")), t(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))


def _set(name: str, sql: str, f) -> None:
    query(f"select c_nationkey as k from customer {sql} select s_nationkey as k from supplier", name)(lambda spark, d: f(*_nations(spark, d)))


_set("set_union", "union", lambda a, b: a.union(b).distinct())
_set("set_union_all", "union all", lambda a, b: a.unionByName(b))
_set("set_intersect", "intersect", lambda a, b: a.intersect(b))
_set("set_intersect_all", "intersect all", lambda a, b: a.intersectAll(b))
_set("set_except", "except", lambda a, b: a.subtract(b))
_set("set_except_all", "except all", lambda a, b: a.exceptAll(b))


@query("select distinct o_orderstatus, o_orderpriority from orders")
def select_distinct(spark, d):
    return t(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


# as-of and range joins, made of windows and equi-joins


@query("""select p.event_id, (select max(c.event_id) from events c where c.user_id = p.user_id and c.event_type = 'click' and c.ts <= p.ts
  and c.ts = (select max(e.ts) from events e where e.user_id = p.user_id and e.event_type = 'click' and e.ts <= p.ts)) as click_id
from events p where p.event_type = 'purchase'""")
def join_asof(spark, d):
    from quarry.operators.joins import asof_join

    events = t(spark, d, "events")
    left = events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    right = events.filter("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"))
    return asof_join(left, right, ["user_id"], "ts", ["click_id"]).select("event_id", "click_id")


@query("""select b.event_id as bid, e.event_id as eid from events b join events e on b.event_type = 'signup' and e.event_type = 'error'
and e.ts >= b.ts and e.ts < b.ts + interval 10 minute""")
def join_range(spark, d):
    from quarry.operators.joins import range_join

    events = t(spark, d, "events")
    spans = events.filter("event_type = 'signup'").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("low"), F.col("event_id").alias("bid"))
    spans = spans.withColumn("high", F.col("low") + 600_000_000)
    points = events.filter("event_type = 'error'").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.col("event_id").alias("eid"))
    return range_join(points, spans, "at", "low", "high", 600_000_000).select("bid", "eid")


@query("select user_id, cast(sum(x) as double) as total from (select user_id, cast(value as decimal(12,2)) as x from events) e group by 1")
def agg_user_total(spark, d):
    return t(spark, d, "events").groupBy("user_id").agg(F.sum(money("value")).cast("double").alias("total"))


