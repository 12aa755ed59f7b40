"""Aggregates, states, table engines and window functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quarry.operators import aggregates as A
from quarry.operators import engines as E
from quarry.operators import maps as M
from quarry.operators.quantiles import exact_quantile
from quarry.plans.registry import query
from quarry.plans.tables import REVENUE, money, revenue, t


def _by_flag(name: str, sql: str, *columns) -> None:
    """Aggregates of lineitem by return flag."""
    query(f"select l_returnflag, {sql} from lineitem group by 1", name)(lambda spark, d: t(spark, d, "lineitem").groupBy("l_returnflag").agg(*[c() for c in columns]))


@query("select count(*) as n, min(l_quantity) as lo, max(l_quantity) as hi from lineitem")
def agg_global(spark, d):
    return t(spark, d, "lineitem").agg(F.count("*").alias("n"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))


@query("select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2")
def agg_group_by(spark, d):
    return t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("select l_orderkey % 10 as k, 1 as one, count(*) as n from lineitem group by 1, 2")
def agg_group_expr(spark, d):
    return t(spark, d, "lineitem").groupBy((F.col("l_orderkey") % 10).alias("k"), F.lit(1).alias("one")).agg(F.count("*").alias("n"))


@query("select l_suppkey, count(*) as n from lineitem group by 1 having count(*) > 500 and min(l_quantity) < 2")
def agg_having(spark, d):
    return t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.min("l_quantity").alias("m")).filter("n > 500 and m < 2").drop("m")


_by_flag("agg_expr_over_aggs", f"cast(sum({REVENUE}) as double) / count(*) as r, max(l_quantity) - min(l_quantity) as spread", lambda: (F.sum(revenue()).cast("double") / F.count("*")).alias("r"), lambda: (F.max("l_quantity") - F.min("l_quantity")).alias("spread"))
_by_flag("agg_count", "count(*) as n, count(nullif(l_linenumber, 1)) as m", lambda: F.count("*").alias("n"), lambda: F.count(F.nullif(F.col("l_linenumber"), F.lit(1))).alias("m"))
_by_flag(
    "agg_basic", "cast(sum(cast(l_quantity as decimal(12,2))) as double) as s, min(l_shipdate) as lo, max(l_shipdate) as hi, cast(sum(cast(l_quantity as decimal(12,2))) as double) / count(l_quantity) as a",
    lambda: F.sum(money("l_quantity")).cast("double").alias("s"), lambda: F.min("l_shipdate").alias("lo"), lambda: F.max("l_shipdate").alias("hi"), lambda: (F.sum(money("l_quantity")).cast("double") / F.count("l_quantity")).alias("a"),
)
_by_flag("agg_sum_const", "cast(sum(1) as bigint) as n", lambda: F.sum(F.lit(1)).alias("n"))
_by_flag("agg_count_distinct", "count(distinct l_suppkey) as n", lambda: F.count_distinct("l_suppkey").alias("n"))
_by_flag("agg_filter", "min(l_orderkey) filter (where l_quantity > 49) as lo, cast(sum(l_linenumber) filter (where l_tax > 0.05) as bigint) as s", lambda: A.when_true(F.min, F.col("l_quantity") > 49, F.col("l_orderkey")).alias("lo"), lambda: A.when_true(F.sum, F.col("l_tax") > 0.05, F.col("l_linenumber")).alias("s"))
_by_flag("agg_count_filter", "count(*) filter (where l_quantity < 20) as n", lambda: F.count_if(F.col("l_quantity") < 20).alias("n"))
_by_flag("agg_distinct_filter", "count(distinct l_suppkey) filter (where l_quantity < 3) as n", lambda: F.count_distinct(F.when(F.col("l_quantity") < 3, F.col("l_suppkey"))).alias("n"))
_by_flag("agg_uniq_exact", "count(distinct l_partkey) as n", lambda: A.uniq_exact(F.col("l_partkey")).alias("n"))
_by_flag("agg_uniq_exact_multi", "count(distinct (l_orderkey, l_linenumber)) as n", lambda: A.uniq_exact(F.col("l_orderkey"), F.col("l_linenumber")).alias("n"))
_by_flag("agg_uniq_exact_if", "count(distinct l_partkey) filter (where l_quantity > 40) as n", lambda: A.uniq_exact_if(F.col("l_quantity") > 40, F.col("l_partkey")).alias("n"))


def _quantile(name: str, sql: str, p: float, x, interpolate: bool = True) -> None:
    """An exact quantile by return flag: by brackets, so that no group's values need fit in a task."""
    query(f"select l_returnflag, {sql} as q from lineitem group by 1", name)(lambda spark, d: exact_quantile(t(spark, d, "lineitem"), ["l_returnflag"], x(), p, interpolate=interpolate))


_quantile("agg_quantile_default", "quantile_cont(l_quantity, 0.5)", 0.5, lambda: F.col("l_quantity"))
_quantile("agg_quantile", "quantile_cont(l_quantity, 0.25)", 0.25, lambda: F.col("l_quantity"))
_quantile("agg_quantile_if", "quantile_cont(l_quantity, 0.9) filter (where l_linenumber = 1)", 0.9, lambda: F.when(F.col("l_linenumber") == 1, F.col("l_quantity")))
_quantile("agg_percentile_cont", "quantile_cont(l_extendedprice, 0.5)", 0.5, lambda: F.col("l_extendedprice"))
_quantile("agg_percentile_cont_filter", "quantile_cont(l_quantity, 0.25) filter (where l_linenumber = 1)", 0.25, lambda: F.when(F.col("l_linenumber") == 1, F.col("l_quantity")))
_quantile("agg_percentile_expr", "quantile_cont(cast(floor(epoch(l_shipdate)) as bigint), 0.5)", 0.5, lambda: F.unix_timestamp("l_shipdate"))
_quantile("agg_quantile_exact", "cast(quantile_disc(l_quantity, 0.75) as double)", 0.75, lambda: F.col("l_quantity"), interpolate=False)


for _name, _f in (("agg_argmin", "min"), ("agg_argmax", "max")):
    query(f"select o_orderstatus, arg_{_f}(o_orderkey, (o_totalprice, o_orderkey)) as k from orders group by 1", _name)(
        lambda spark, d, f=A.arg_min if _f == "min" else A.arg_max: t(spark, d, "orders").groupBy("o_orderstatus").agg(f(F.col("o_orderkey"), F.struct("o_totalprice", "o_orderkey")).alias("k"))
    )


def _close(name: str, estimate, tolerance: float) -> None:
    """An approximate count beside the exact one: whether they agree within three standard errors of the sketch."""

    def run(spark, d):
        both = t(spark, d, "lineitem").groupBy("l_returnflag").agg(estimate().cast("double").alias("e"), F.count_distinct("l_partkey").alias("n"))
        return both.select("l_returnflag", "n", (F.abs(F.col("e") - F.col("n")) <= tolerance * F.col("n")).alias("close"))

    query("select l_returnflag, count(distinct l_partkey) as n, true as close from lineitem group by 1", name)(run)


_close("agg_uniq", lambda: A.uniq(F.col("l_partkey")), 0.03)
_close("agg_uniq_combined", lambda: A.uniq_combined(F.col("l_partkey")), 0.025)
_close("agg_uniq_combined64", lambda: A.uniq_combined64(F.col("l_partkey")), 0.01)
_close("agg_uniq_hll12", lambda: A.uniq_hll12(F.col("l_partkey")), 0.05)
_close("agg_uniq_theta", lambda: A.uniq_theta(F.col("l_partkey")), 0.05)


# states made by day or month, merged later


def _merged(name: str, kind: str, sql: str, column, result) -> None:
    def run(spark, d):
        lines = t(spark, d, "lineitem").withColumn("m", F.month("l_shipdate"))
        states = lines.groupBy("l_returnflag", "m").agg(*A.state(kind, "x", column()))
        return states.groupBy("l_returnflag").agg(result(A.merge(kind, "x")).alias("v"))

    query(f"select l_returnflag, {sql} as v from lineitem group by 1", name)(run)


_merged("agg_sum_merge", "sum", "cast(sum(l_linenumber) as bigint)", lambda: F.col("l_linenumber"), lambda c: c)
_merged("agg_count_merge", "count", "count(nullif(l_linenumber, 1))", lambda: F.nullif(F.col("l_linenumber"), F.lit(1)), lambda c: c)
_merged("agg_min_merge", "min", "min(l_quantity)", lambda: F.col("l_quantity"), lambda c: c)
_merged("agg_max_merge", "max", "max(l_quantity)", lambda: F.col("l_quantity"), lambda c: c)
_merged("agg_avg_merge", "avg", "sum(l_linenumber) / count(l_linenumber)", lambda: F.col("l_linenumber"), lambda c: c.cast("double"))


def _near(name: str, kind: str, exact, tolerance: float, column: str, sql: str) -> None:
    def run(spark, d):
        days = t(spark, d, "events").withColumn("day", F.to_date("ts"))
        states = days.groupBy("event_type", "day").agg(*A.state(kind, "x", F.col(column)))
        e = states.groupBy("event_type").agg(A.merge(kind, "x").cast("double").alias("e"))
        n = days.groupBy("event_type").agg(exact().cast("double").alias("n"))
        return e.join(n, "event_type").select("event_type", "n", (F.abs(F.col("e") - F.col("n")) <= tolerance * F.abs(F.col("n"))).alias("close"))

    query(f"select event_type, cast({sql} as double) as n, true as close from events group by 1", name)(run)


_near("agg_uniq_merge", "uniq", lambda: F.count_distinct("user_id"), 0.05, "user_id", "count(distinct user_id)")
_near("agg_uniq_hll_merge", "uniqHLL12", lambda: F.count_distinct("user_id"), 0.05, "user_id", "count(distinct user_id)")
_near("agg_quantile_merge", "quantile", lambda: F.percentile("event_id", F.lit(0.5)), 0.1, "event_id", "quantile_cont(event_id, 0.5)")


# collapsing and replacing tables

_SIGNED = "from orders where o_orderpriority <> '5-LOW' group by 1"


def _signed(spark, d):
    """Orders, of which those of low priority were entered and cancelled."""
    orders = t(spark, d, "orders").withColumn("x", F.nullif((F.col("o_orderkey") % 7).cast("int"), F.lit(3)))
    return orders.withColumn("sign", F.lit(1)).unionByName(orders.filter("o_orderpriority = '5-LOW'").withColumn("sign", F.lit(-1)))


def _collapsing(name: str, sql: str, column) -> None:
    query(f"select o_orderstatus, {sql} as v {_SIGNED}", name)(lambda spark, d: _signed(spark, d).groupBy("o_orderstatus").agg(column(E.Collapsing.parse("CollapsingMergeTree(sign)")).alias("v")))


_collapsing("agg_collapsing_sum", "cast(sum(nullif(o_orderkey % 7, 3)) as bigint)", lambda c: c.sum(F.col("x")))
_collapsing("agg_collapsing_count", "count(*)", lambda c: c.count())
_collapsing("agg_collapsing_count_column", "count(nullif(o_orderkey % 7, 3))", lambda c: c.count(F.col("x")))
_collapsing("agg_collapsing_count_filter", "count(*) filter (where o_orderkey % 2 = 0)", lambda c: c.count(condition=F.col("o_orderkey") % 2 == 0))
_collapsing("agg_collapsing_avg", "avg(nullif(o_orderkey % 7, 3))", lambda c: c.avg(F.col("x")).cast("double"))


@query("select o_orderkey, o_orderstatus from orders where o_orderpriority <> '5-LOW'")
def engine_final_collapsing(spark, d):
    return E.final_collapsing(_signed(spark, d).select("o_orderkey", "o_orderstatus", "sign"), ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def engine_final_replacing(spark, d):
    return E.final_replacing(t(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("select cast(ts as date) as day, event_type as key, count(*) as value from events group by 1, 2")
def agg_sum_map(spark, d):
    one = t(spark, d, "events").select(F.to_date("ts").alias("day"), F.create_map("event_type", F.lit(1).cast("bigint")).alias("m"))
    return M.sum_map(one, ["day"], "m")


@query("select r.l_returnflag, r.l_linestatus, count(*) as n from lineitem r group by rollup (r.l_returnflag, r.l_linestatus)")
def agg_rollup(spark, d):
    return t(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("select l_returnflag, l_linestatus, count(*) as n, cast(grouping(l_returnflag) as int) as g from lineitem group by cube (l_returnflag, l_linestatus)")
def agg_cube(spark, d):
    return t(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.grouping("l_returnflag").cast("int").alias("g"))


@query("select l_returnflag, l_linestatus, l_linenumber, count(*) as n from lineitem group by grouping sets ((l_returnflag, l_linestatus), (l_linenumber), ())")
def agg_grouping_sets(spark, d):
    sets = [[F.col("l_returnflag"), F.col("l_linestatus")], [F.col("l_linenumber")], []]
    return t(spark, d, "lineitem").groupingSets(sets, "l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"))


@query("select l_returnflag, any_value(l_returnflag) as a, bool_and(l_quantity > 0) as p, bool_or(l_quantity > 49) as q, mode(l_returnflag) as m from lineitem group by 1")
def agg_ordered_and_boolean(spark, d):
    return t(spark, d, "lineitem").groupBy("l_returnflag").agg(F.any_value("l_returnflag").alias("a"), F.bool_and(F.col("l_quantity") > 0).alias("p"), F.bool_or(F.col("l_quantity") > 49).alias("q"), F.mode("l_returnflag").alias("m"))


# windows; each frame is within a key, so that none needs all rows in one task

_EVENTS = "from events"
_BY_USER = "partition by user_id order by ts, event_id"


def _by_user():
    return W.partitionBy("user_id").orderBy("ts", "event_id")


def _window(name: str, sql: str, *columns) -> None:
    query(f"select event_id, {sql} {_EVENTS}", name)(lambda spark, d: t(spark, d, "events").select("event_id", *[c() for c in columns]))


_window("win_row_number", f"row_number() over ({_BY_USER}) as r", lambda: F.row_number().over(_by_user()).cast("bigint").alias("r"))
_window(
    "win_rank", "rank() over (partition by user_id order by event_type) as r, dense_rank() over (partition by user_id order by event_type) as k",
    lambda: F.rank().over(W.partitionBy("user_id").orderBy("event_type")).cast("bigint").alias("r"), lambda: F.dense_rank().over(W.partitionBy("user_id").orderBy("event_type")).cast("bigint").alias("k"),
)
_window(
    "win_distribution", f"ntile(4) over ({_BY_USER}) as t, percent_rank() over ({_BY_USER}) as p, cume_dist() over ({_BY_USER}) as c",
    lambda: F.ntile(4).over(_by_user()).cast("bigint").alias("t"), lambda: F.percent_rank().over(_by_user()).alias("p"), lambda: F.cume_dist().over(_by_user()).alias("c"),
)
_window("win_lag_lead", f"lag(event_id) over ({_BY_USER}) as a, lead(event_id, 2, cast(-1 as bigint)) over ({_BY_USER}) as b", lambda: F.lag("event_id").over(_by_user()).alias("a"), lambda: F.lead("event_id", 2, -1).over(_by_user()).alias("b"))
_WHOLE = "rows between unbounded preceding and unbounded following"
_window(
    "win_first_last", f"first_value(event_id) over ({_BY_USER} {_WHOLE}) as a, last_value(event_id) over ({_BY_USER} {_WHOLE}) as b, nth_value(event_id, 2) over ({_BY_USER} {_WHOLE}) as c",
    lambda: F.first("event_id").over(_by_user().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("a"),
    lambda: F.last("event_id").over(_by_user().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("b"),
    lambda: F.nth_value("event_id", 2).over(_by_user().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("c"),
)
_window("win_running_sum", "cast(sum(event_id) over (partition by user_id order by event_type) as bigint) as s", lambda: F.sum("event_id").over(W.partitionBy("user_id").orderBy("event_type")).alias("s"))
_window("win_frame_avg", f"cast(sum(event_id) over ({_BY_USER} rows between 2 preceding and current row) as bigint) as s, count(*) over ({_BY_USER} rows between 2 preceding and current row) as n", lambda: F.sum("event_id").over(_by_user().rowsBetween(-2, 0)).alias("s"), lambda: F.count("*").over(_by_user().rowsBetween(-2, 0)).alias("n"))
_window("win_range_frame", "count(*) over (partition by user_id order by event_id range between 500 preceding and current row) as n", lambda: F.count("*").over(W.partitionBy("user_id").orderBy("event_id").rangeBetween(-500, 0)).alias("n"))


@query("select user_id, event_id from events qualify row_number() over (partition by user_id order by event_id desc) <= 3")
def win_topn_per_group(spark, d):
    ranked = t(spark, d, "events").select("user_id", "event_id", F.row_number().over(W.partitionBy("user_id").orderBy(F.col("event_id").desc())).alias("r"))
    return ranked.filter("r <= 3").select("user_id", "event_id")


@query("select date_trunc('day', ts) as start, event_type, count(*) as n from events group by 1, 2")
def win_tumbling_batch(spark, d):
    from quarry.streaming.windows import tumbling

    return tumbling(t(spark, d, "events"), "ts", "1 day", ["event_type"], [F.count("*").alias("n")]).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""select date_trunc('hour', ts) - to_hours(k) as start, count(*) as n from events, (values (0), (1)) v(k) group by 1""")
def win_sliding_batch(spark, d):
    from quarry.streaming.windows import sliding

    return sliding(t(spark, d, "events"), "ts", "2 hours", "1 hour", [], [F.count("*").alias("n")]).select(F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("""with e as (select user_id, ts, case when ts < lag(ts) over w + interval 1 hour then 0 else 1 end as fresh from events window w as (partition by user_id order by ts)),
s as (select user_id, ts, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as k from e)
select user_id, min(ts) as start, count(*) as n from s group by user_id, k""")
def win_session_batch(spark, d):
    from quarry.streaming.windows import session

    return session(t(spark, d, "events"), "ts", "1 hour", ["user_id"], [F.count("*").alias("n")]).select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("select l_returnflag, quantile_disc(l_extendedprice, 0.99) as q from lineitem group by 1")
def agg_quantile_large_groups(spark, d):
    from quarry.operators.quantiles import exact_quantile

    return exact_quantile(t(spark, d, "lineitem"), ["l_returnflag"], F.col("l_extendedprice"), 0.99, interpolate=False)


# the dialect's aggregates in statements, over a catalog's tables


def _catalog(spark, d, *names: str):
    from quarry.sources.catalog import Catalog

    catalog = Catalog(spark)
    catalog.import_schema(d, limit_to=list(names))
    return catalog


@query("""select l_returnflag, arg_max(l_orderkey, (l_shipdate, l_orderkey, l_linenumber)) as last, count(distinct (l_orderkey, l_linenumber)) as n, sum(l_linenumber) filter (where l_quantity > 25) as s,
count(*) filter (where l_discount > 0.05) as c, quantile_cont(l_quantity, 0.25) as q, cast(quantile_disc(l_quantity, 0.75) as double) as e, avg(l_linenumber) filter (where l_quantity < 3) as a from lineitem group by 1""")
def sql_aggregates(spark, d):
    return _catalog(spark, d, "lineitem").sql(
        """select l_returnflag, argMax(l_orderkey, struct(l_shipdate, l_orderkey, l_linenumber)) as last, uniqExact(l_orderkey, l_linenumber) as n, sumIf(l_linenumber, l_quantity > 25) as s,
        countIf(l_discount > 0.05D) as c, quantile(0.25)(l_quantity) as q, quantileExact(0.75)(l_quantity) as e, avg(l_linenumber) filter (where l_quantity < 3) as a from lineitem group by 1"""
    )


@query("""select l_returnflag, sum(l_linenumber) as s, count(*) filter (where l_quantity > 10) as c, avg(l_linenumber) as a, min(l_quantity) as lo, count(distinct l_suppkey) as n,
arg_min(l_partkey, (l_shipdate, l_orderkey, l_linenumber)) as first from lineitem group by 1""")
def sql_states(spark, d):
    catalog = _catalog(spark, d, "lineitem")
    states = catalog.sql(
        """select l_returnflag, l_shipmonth, sumState(l_linenumber) as s, countIfState(l_quantity > 10) as c, avgState(l_linenumber) as a, minState(l_quantity) as lo, uniqExactState(l_suppkey) as n,
        argMinState(l_partkey, struct(l_shipdate, l_orderkey, l_linenumber)) as first from (select *, month(l_shipdate) as l_shipmonth from lineitem) group by 1, 2"""
    )
    states.createOrReplaceTempView("line_states")
    return catalog.sql("select l_returnflag, sumMerge(s) as s, countMerge(c) as c, avgMerge(a) as a, minMerge(lo) as lo, uniqExactMerge(n) as n, argMinMerge(first) as first from line_states group by 1")


@query(f"select o_orderstatus, cast(sum(nullif(o_orderkey % 7, 3)) as bigint) as s, count(*) as c, count(nullif(o_orderkey % 7, 3)) as cx, avg(nullif(o_orderkey % 7, 3)) as a {_SIGNED}")
def sql_collapsing(spark, d):
    from quarry.sources.catalog import Table

    catalog, rows = _catalog(spark, d), _signed(spark, d)
    rows.createOrReplaceTempView("signed_orders")
    catalog.tables["signed_orders"] = Table("signed_orders", "", rows.schema, {"engine": "CollapsingMergeTree(sign)"})
    return catalog.sql("select o_orderstatus, sum(x) as s, count(*) as c, count(x) as cx, avg(x) as a from signed_orders group by 1")


@query("select c_custkey, coalesce(n_name, '') as nation, coalesce(n_regionkey, 0) as region from customer left join nation on n_nationkey = c_nationkey + 3")
def sql_dict_get(spark, d):
    catalog = _catalog(spark, d, "customer")
    catalog.create_dictionary("nations", t(spark, d, "nation"), "n_nationkey")
    return catalog.sql("select c_custkey, dictGet('nations', 'n_name', c_nationkey + 3) as nation, dictGet('nations', 'n_regionkey', c_nationkey + 3) as region from customer")

