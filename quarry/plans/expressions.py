"""Scalar functions, casts, maps, dictionaries and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import scalars as S
from quarry.operators import maps as M
from quarry.operators.dictionary import Dictionary
from quarry.plans.registry import query
from quarry.plans.tables import t


def _select(name: str, table: str, key: str, sql: str, **columns) -> None:
    """key and some expressions of each row of a table."""
    query(f"select {key}, {sql} from {table}", name)(lambda spark, d: t(spark, d, table).select(key, *[c().alias(n) for n, c in columns.items()]))


# strings

_select(
    "fn_trim", "part", "p_partkey", "trim('  ' || p_name || ' ') as a, trim(p_brand, 'B#') as b, ltrim(p_type, 'S') as l, rtrim(p_type, 'DO') as r",
    a=lambda: F.btrim(F.concat(F.lit("  "), "p_name", F.lit(" "))), b=lambda: F.btrim("p_brand", F.lit("B#")), l=lambda: F.ltrim("p_type", F.lit("S")), r=lambda: F.rtrim("p_type", F.lit("DO")),
)
_select("fn_strpos", "part", "p_partkey", "cast(strpos(p_name, 'ring') as int) as i, cast(strpos(p_name, 'zzz') as int) as j", i=lambda: S.strpos(F.col("p_name"), "ring"), j=lambda: S.strpos(F.col("p_name"), "zzz"))
_select("fn_length", "documents", "doc_id", "length(text) as n, octet_length(encode(text)) as b", n=lambda: F.length("text"), b=lambda: F.octet_length("text"))
_select("fn_concat", "nation", "n_nationkey", "n_name || '/' || cast(n_regionkey as varchar) as c, concat_ws('-', n_name, n_name) as w", c=lambda: F.concat("n_name", F.lit("/"), F.col("n_regionkey").cast("string")), w=lambda: F.concat_ws("-", "n_name", "n_name"))
_select(
    "fn_string_misc", "part", "p_partkey",
    "lower(p_type) as lo, upper(p_name) as up, substr(p_name, 2, 3) as su, replace(p_brand, '#', '-') as re, left(p_name, 2) as le, right(p_name, 2) as ri, reverse(p_name) as rv, lpad(cast(p_size as varchar), 4, '0') as lp, repeat('x', p_size % 3) as rp, split_part(p_brand, '#', 2) as sp, starts_with(p_type, 'S') as st, regexp_replace(p_brand, '[0-9]+', 'n') as rr, translate(p_type, 'SD', 'sd') as tr, ascii(p_name) as ac, md5(p_name) as h",
    lo=lambda: F.lower("p_type"), up=lambda: F.upper("p_name"), su=lambda: F.substring("p_name", 2, 3), re=lambda: F.replace(F.col("p_brand"), F.lit("#"), F.lit("-")), le=lambda: F.left(F.col("p_name"), F.lit(2)), ri=lambda: F.right(F.col("p_name"), F.lit(2)),
    rv=lambda: F.reverse("p_name"), lp=lambda: F.lpad(F.col("p_size").cast("string"), 4, "0"), rp=lambda: F.repeat(F.lit("x"), F.col("p_size") % 3), sp=lambda: F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)), st=lambda: F.startswith(F.col("p_type"), F.lit("S")),
    rr=lambda: F.regexp_replace("p_brand", "[0-9]+", "n"), tr=lambda: F.translate("p_type", "SD", "sd"), ac=lambda: F.ascii("p_name"), h=lambda: F.md5("p_name"),
)
_select("fn_to_char", "part", "p_partkey", "lpad(cast(p_size as varchar), 3, '0') as c", c=lambda: F.format_string("%03d", "p_size"))

# dates

for _unit in S.UNITS:
    _select(f"fn_date_trunc_{_unit}", "events", "event_id", f"cast(date_trunc('{_unit}', ts) as timestamp) as x", x=lambda u=_unit: S.date_trunc(u, F.col("ts")))


def _part(unit: str, sql: str | None = None) -> str:
    return f"cast(date_part('{sql or unit}', ts) as int) as {unit}"


_parts = ("day", "doy", "month", "year", "hour", "minute", "quarter")
_select("fn_date_part", "events", "event_id", ", ".join(map(_part, _parts)) + ", cast(floor(date_part('second', ts)) as int) as second", **{u: lambda u=u: S.date_part(u, F.col("ts")) for u in (*_parts, "second")})
_select("fn_date_part_dow", "events", "event_id", _part("dow") + ", " + _part("isodow"), dow=lambda: S.date_part("dow", F.col("ts")), isodow=lambda: S.date_part("isodow", F.col("ts")))
_select("fn_iso_week", "orders", "o_orderkey", "cast(date_part('week', o_orderdate) as int) as week, cast(date_part('isoyear', o_orderdate) as int) as y", week=lambda: S.date_part("week", F.col("o_orderdate")), y=lambda: S.date_part("isoyear", F.col("o_orderdate")))
_select("fn_epoch", "events", "event_id", "cast(floor(epoch(ts)) as bigint) as e", e=lambda: S.date_part("epoch", F.col("ts")))
_select("fn_timezone", "events", "event_id", "(ts at time zone 'UTC') at time zone 'Europe/Berlin' as z", z=lambda: S.to_time_zone("Europe/Berlin", F.col("ts")))
_select("fn_cast_date", "events", "event_id", "cast(ts as date) as d, cast(cast(ts as date) as timestamp) as m", d=lambda: F.to_date("ts"), m=lambda: F.to_date("ts").cast("timestamp_ntz"))
_select("fn_ts_add_interval", "orders", "o_orderkey", "o_orderdate + interval 1 month + interval 3 day + interval 7 second as x, o_orderdate - interval 2 day as y", x=lambda: S.add_interval(F.col("o_orderdate"), 1, 3, 7), y=lambda: S.add_interval(F.col("o_orderdate"), days=-2))
_select(
    "fn_ts_add_dynamic", "orders", "o_orderkey", "o_orderdate + to_days(cast(o_orderkey % 40 as int)) as x, o_orderdate + to_months(cast(o_orderkey % 5 as int)) as y",
    x=lambda: F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 40).cast("int")), y=lambda: F.col("o_orderdate") + F.make_ym_interval(F.lit(0), (F.col("o_orderkey") % 5).cast("int")),
)
_select("fn_day_diff", "orders", "o_orderkey", "cast(trunc((epoch(timestamp '1998-01-01 12:00:00') - epoch(o_orderdate)) / 86400) as bigint) as n", n=lambda: S.day_diff(F.col("o_orderdate"), F.lit("1998-01-01 12:00:00").cast("timestamp_ntz")))

# numbers and conditions

_select("fn_int_div", "part", "p_partkey", "cast(-p_partkey // 7 as bigint) as q, p_partkey % 7 as r, cast(p_partkey // nullif(p_size % 3, 0) as bigint) as z", q=lambda: S.int_div(-F.col("p_partkey"), F.lit(7)), r=lambda: F.col("p_partkey") % 7, z=lambda: S.int_div(F.col("p_partkey"), (F.col("p_size") % 3).cast("bigint")))
_select(
    "fn_math", "part", "p_partkey", "abs(p_size - 25) as a, round(p_retailprice, 1) as r, floor(p_retailprice) as f, ceil(p_retailprice) as c, sqrt(p_size) as s, sign(p_size - 25) as g, cast(factorial(p_size % 10) as bigint) as n, p_size & 6 as b, xor(p_size, 5) as x, greatest(mod(p_size, 4), 1) as m",
    a=lambda: F.abs(F.col("p_size") - 25), r=lambda: F.round("p_retailprice", 1), f=lambda: F.floor("p_retailprice").cast("double"), c=lambda: F.ceil("p_retailprice").cast("double"), s=lambda: F.sqrt("p_size"), g=lambda: F.signum(F.col("p_size") - 25).cast("tinyint"),
    n=lambda: F.factorial(F.col("p_size") % 10), b=lambda: F.col("p_size").bitwiseAND(6), x=lambda: F.col("p_size").bitwiseXOR(5), m=lambda: F.greatest(F.col("p_size") % 4, F.lit(1)),
)
_select("fn_greatest_least", "part", "p_partkey", "greatest(p_size, 10, nullif(p_size, 7)) as g, least(p_size, 10, nullif(p_size, 7)) as l", g=lambda: F.greatest("p_size", F.lit(10), F.nullif(F.col("p_size"), F.lit(7))), l=lambda: F.least("p_size", F.lit(10), F.nullif(F.col("p_size"), F.lit(7))))
_select("fn_case", "part", "p_partkey", "case when p_size < 10 then 's' when p_size < 30 then 'm' else 'l' end as c, case when p_size = 1 then true end as b", c=lambda: F.when(F.col("p_size") < 10, "s").when(F.col("p_size") < 30, "m").otherwise("l"), b=lambda: F.when(F.col("p_size") == 1, True))
_select("fn_case_simple", "orders", "o_orderkey", "case o_orderstatus when 'F' then 1 when 'O' then 2 else 0 end as c", c=lambda: F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(0))
_select("fn_coalesce", "part", "p_partkey", "coalesce(nullif(p_size, 1), nullif(p_size, 2), 0) as c", c=lambda: F.coalesce(F.nullif(F.col("p_size"), F.lit(1)), F.nullif(F.col("p_size"), F.lit(2)), F.lit(0)))
_select("fn_nullif", "part", "p_partkey", "nullif(p_type, 'PROMO') as c", c=lambda: F.nullif(F.col("p_type"), F.lit("PROMO")))

# arrays and rows


def _items():
    return F.array("p_size", F.lit(7), (F.col("p_partkey") % 50).cast("int"))


_ITEMS = "[p_size, 7, cast(p_partkey % 50 as int)]"
_select("fn_array_build", "part", "p_partkey", f"cast(len({_ITEMS}) as int) as n, array_to_string({_ITEMS}, ',') as s, cast(len(cast([] as int[])) as int) as e", n=lambda: F.size(_items()), s=lambda: F.array_join(_items().cast("array<string>"), ","), e=lambda: F.size(F.array().cast("array<int>")))
_select("fn_array_subscript", "part", "p_partkey", f"{_ITEMS}[1] as a, {_ITEMS}[9] as z, array_to_string({_ITEMS}[2:3], ',') as s", a=lambda: S.subscript(_items(), 1), z=lambda: S.subscript(_items(), 9), s=lambda: F.array_join(S.subarray(_items(), 2, 3).cast("array<string>"), ","))
_select("fn_array_position", "part", "p_partkey", f"cast(list_position({_ITEMS}, 7) as bigint) as p, cast(list_position({_ITEMS}, -1) as bigint) as q", p=lambda: S.index_of(_items(), F.lit(7)), q=lambda: S.index_of(_items(), F.lit(-1)))
_select("fn_array_count_equal", "part", "p_partkey", f"cast(len(list_filter({_ITEMS}, lambda x: x = 7)) as int) as n, list_contains({_ITEMS}, 3) as h", n=lambda: S.count_equal(_items(), F.lit(7)), h=lambda: S.any_of(F.lit(3), _items()))
_select("fn_row", "nation", "n_nationkey", "row(n_name, n_regionkey) = row('NATION_1', 1) as e", e=lambda: F.struct(F.col("n_name").alias("a"), F.col("n_regionkey").alias("b")) == F.struct(F.lit("NATION_1").alias("a"), F.lit(1).alias("b")))

@query("select n_nationkey, unnest([n_regionkey, n_nationkey]) as x from nation")
def fn_unnest(spark, d):
    return t(spark, d, "nation").select("n_nationkey", F.explode(F.array("n_regionkey", "n_nationkey")).alias("x"))


# maps


def _map():
    return F.create_map(F.lit(1), F.col("p_size").cast("bigint"), F.lit(3), F.col("p_partkey"))


_select("fn_map_fetch", "part", "p_partkey", "cast(p_size as bigint) as a, cast(null as bigint) as b", a=lambda: S.map_fetch(_map(), F.lit(1)), b=lambda: S.map_fetch(_map(), F.lit(2)))
_select("fn_map_sum_up", "part", "p_partkey", "p_size + p_partkey as a, cast(p_size as bigint) as b", a=lambda: S.map_sum_up(_map()), b=lambda: S.map_sum_up(_map(), F.lit(2)))
_select("fn_map_seed", "part", "p_partkey", "cast(p_size + 1 as int) as n, cast((p_size + 1) * 5 as bigint) as s", n=lambda: F.size(S.map_seed(0, F.col("p_size"), F.lit(5).cast("bigint"))), s=lambda: S.map_sum_up(S.map_seed(0, F.col("p_size"), F.lit(5).cast("bigint"))))
_select("fn_map_slice", "part", "p_partkey", "p_partkey as v", v=lambda: S.map_sum_up(F.map_filter(_map(), lambda k, v: k.isin(3, 4))))


@query("""with m as (select o_orderstatus, month(o_orderdate) as k, count(*) as n from orders where month(o_orderdate) not in (2, 5, 8, 11) group by 1, 2),
g as (select o_orderstatus, unnest(generate_series((select min(k) from m), 12)) as k from (select distinct o_orderstatus from m) s)
select o_orderstatus, cast(g.k as int) as key, cast(sum(coalesce(n, 0)) over (partition by o_orderstatus order by g.k) as bigint) as value from g left join m using (o_orderstatus, k)""")
def fn_map_accumulate(spark, d):
    month = F.month("o_orderdate").alias("key")
    counted = t(spark, d, "orders").filter(~F.month("o_orderdate").isin(2, 5, 8, 11)).groupBy("o_orderstatus", month).agg(F.count("*").alias("value"))
    maps = M.collect_map(counted, ["o_orderstatus"], "m")
    return maps.select("o_orderstatus", F.explode(S.map_accumulate(F.col("m"), F.lit(12))).alias("key", "value"))


@query("""select o_orderstatus, cast(1 as int) as key, count(*) as value from orders group by 1 union all select o_orderstatus, 2, cast(sum(o_orderkey % 3) as bigint) from orders group by 1""")
def fn_map_from_arrays(spark, d):
    both = t(spark, d, "orders").select("o_orderstatus", F.array(F.lit(1), F.lit(2)).alias("m_keys"), F.array(F.lit(1).cast("bigint"), F.col("o_orderkey") % 3).alias("m_values"))
    return M.sum_map(M.from_arrays(both, "m", "m_keys", "m_values"), ["o_orderstatus"], "m")


# dictionaries


@query("select c_custkey, coalesce(n_name, '') as nation from customer left join nation on n_nationkey = c_nationkey + 3")
def dict_get(spark, d):
    nations = Dictionary(t(spark, d, "nation"), ("n_nationkey",))
    return nations.get(t(spark, d, "customer"), "n_name", [F.col("c_nationkey") + 3], "nation").select("c_custkey", "nation")


@query("""with k as (select l_partkey, l_suppkey, count(*) as n from lineitem where l_quantity > 25 group by 1, 2)
select l_orderkey, l_linenumber, coalesce(n, cast(0 as bigint)) as n from lineitem left join k using (l_partkey, l_suppkey)""")
def dict_get_composite(spark, d):
    lines = t(spark, d, "lineitem")
    counted = lines.filter("l_quantity > 25").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))
    found = Dictionary(counted, ("l_partkey", "l_suppkey")).get(lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "n", [F.col("l_partkey"), F.col("l_suppkey")], "n", 0)
    return found.select("l_orderkey", "l_linenumber", "n")


@query("select n_name, count(*) as n from customer join nation on c_nationkey = n_nationkey where n_name <> 'NATION_3' group by 1")
def dict_join(spark, d):
    return t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).filter("n_name <> 'NATION_3'").groupBy("n_name").agg(F.count("*").alias("n"))


# JSON

_select("json_extract", "events", "event_id", "json_extract_string(props, '$.k') as k, json_extract_string(props, '$.none') as z", k=lambda: F.get_json_object("props", "$.k"), z=lambda: F.get_json_object("props", "$.none"))
_select("json_variant", "events", "event_id", "cast(json_extract_string(props, '$.k') as bigint) as k", k=lambda: F.variant_get(F.parse_json("props"), "$.k", "bigint"))

# casts

_select("cast_basic", "lineitem", "l_orderkey", "cast(l_linenumber as bigint) as b, cast(l_linenumber as double) as f, try_cast(l_returnflag as int) as n, cast(l_shipdate as date) as d", b=lambda: F.col("l_linenumber").cast("bigint"), f=lambda: F.col("l_linenumber").cast("double"), n=lambda: F.col("l_returnflag").try_cast("int"), d=lambda: F.col("l_shipdate").cast("date"))
_select("cast_to_string", "part", "p_partkey", "cast(p_size as varchar) as s, cast(p_size > 25 as varchar) as b", s=lambda: F.col("p_size").cast("string"), b=lambda: (F.col("p_size") > 25).cast("string"))
_select("cast_touint", "lineitem", "l_orderkey", "cast(l_orderkey % 256 as smallint) as u8, cast((256 - l_linenumber) % 256 as smallint) as neg, cast(l_orderkey as bigint) as u32", u8=lambda: S.to_uint(F.col("l_orderkey"), 8), neg=lambda: S.to_uint(-F.col("l_linenumber"), 8), u32=lambda: S.to_uint(F.col("l_orderkey"), 32))
_select("cast_bool", "part", "p_partkey", "cast(p_size % 2 as boolean) as b, cast(p_size > 25 as int) as i", b=lambda: (F.col("p_size") % 2).cast("boolean"), i=lambda: (F.col("p_size") > 25).cast("int"))
