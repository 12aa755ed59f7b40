"""The TPC-H queries, adapted to the columns that the tables have."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quarry.plans.registry import query
from quarry.plans.tables import REVENUE, day, money, revenue, t


def _total(c, name):
    return F.sum(c).cast("double").alias(name)


@query(f"""select l_returnflag, l_linestatus, cast(sum(cast(l_quantity as decimal(12,2))) as double) as sum_qty, cast(sum({REVENUE}) as double) as revenue, count(*) as n
from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2""")
def tpch_q1(spark, d):
    return t(spark, d, "lineitem").filter(F.col("l_shipdate") <= day("1998-09-02")).groupBy("l_returnflag", "l_linestatus").agg(_total(money("l_quantity"), "sum_qty"), _total(revenue(), "revenue"), F.count("*").alias("n"))


def _bridge(lines):
    """Which supplier sells which part, at the lowest line price, of lines that are already cut to what is asked for."""
    return lines.groupBy(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")).agg(F.min("l_extendedprice").alias("ps_cost"), F.sum(money("l_quantity")).alias("ps_qty"))


_BRIDGE = "select l_partkey as ps_partkey, l_suppkey as ps_suppkey, min(l_extendedprice) as ps_cost, sum(cast(l_quantity as decimal(12,2))) as ps_qty from lineitem group by 1, 2"


@query(f"""with ps as ({_BRIDGE}), e as (select ps_partkey, ps_suppkey, s_name, n_name, ps_cost from ps join supplier on s_suppkey = ps_suppkey join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey where r_name = 'EUROPE')
select p_partkey, s_name, n_name from part join e on ps_partkey = p_partkey where p_size = 15 and ps_cost = (select min(f.ps_cost) from e f where f.ps_partkey = p_partkey)""")
def tpch_q2(spark, d):
    places = t(spark, d, "nation").join(t(spark, d, "region").filter("r_name = 'EUROPE'"), F.col("n_regionkey") == F.col("r_regionkey"))
    sellers = t(spark, d, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_name")
    parts = t(spark, d, "part").filter("p_size = 15").select("p_partkey")
    lines = t(spark, d, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi").join(sellers.select("s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    offers = _bridge(lines).join(sellers, F.col("ps_suppkey") == F.col("s_suppkey")).withColumnRenamed("ps_partkey", "p_partkey")
    return offers.withColumn("m", F.min("ps_cost").over(W.partitionBy("p_partkey"))).filter("ps_cost = m").select("p_partkey", "s_name", "n_name")


@query(f"""select l_orderkey, o_orderdate, cast(sum({REVENUE}) as double) as revenue from customer join orders on c_custkey = o_custkey join lineitem on l_orderkey = o_orderkey
where c_mktsegment = 'BUILDING' and o_orderdate < timestamp '1997-03-15' and l_shipdate > timestamp '1997-03-15' group by 1, 2 order by revenue desc, l_orderkey limit 10""")
def tpch_q3(spark, d):
    people = t(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    early = t(spark, d, "orders").filter(F.col("o_orderdate") < day("1997-03-15")).join(people, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    late = t(spark, d, "lineitem").filter(F.col("l_shipdate") > day("1997-03-15"))
    sums = late.join(early, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_orderkey", "o_orderdate").agg(_total(revenue(), "revenue"))
    return sums.orderBy(F.col("revenue").desc(), "l_orderkey").limit(10)


@query("""select o_orderpriority, count(*) as order_count from orders where o_orderdate >= timestamp '1997-07-01' and o_orderdate < timestamp '1997-10-01'
and exists (select 1 from lineitem where l_orderkey = o_orderkey and l_shipdate > o_orderdate + interval 60 day) group by 1""")
def tpch_q4(spark, d):
    orders = t(spark, d, "orders").filter((F.col("o_orderdate") >= day("1997-07-01")) & (F.col("o_orderdate") < day("1997-10-01")))
    late = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate") + F.expr("interval 60 days"))
    return orders.join(t(spark, d, "lineitem"), late, "left_semi").groupBy("o_orderpriority").agg(F.count("*").alias("order_count")).orderBy("o_orderpriority")


@query(f"""select n_name, cast(sum({REVENUE}) as double) as revenue from customer join orders on c_custkey = o_custkey join lineitem on l_orderkey = o_orderkey
join supplier on l_suppkey = s_suppkey and c_nationkey = s_nationkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
where r_name = 'ASIA' and o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1997-01-01' group by 1""")
def tpch_q5(spark, d):
    places = t(spark, d, "nation").join(t(spark, d, "region").filter("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name")
    year = t(spark, d, "orders").filter((F.col("o_orderdate") >= day("1996-01-01")) & (F.col("o_orderdate") < day("1997-01-01")))
    people = t(spark, d, "customer").join(places.select("n_nationkey"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey", "c_nationkey")
    bought = year.join(people, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    sold = t(spark, d, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_nationkey", "n_name")
    lines = t(spark, d, "lineitem").join(sold, F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.join(bought, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("c_nationkey") == F.col("s_nationkey"))).groupBy("n_name").agg(_total(revenue(), "revenue"))


@query("""select cast(sum(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))) as double) as revenue from lineitem
where l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1997-01-01' and l_discount between 0.05 and 0.07 and l_quantity < 24""")
def tpch_q6(spark, d):
    lines = t(spark, d, "lineitem").filter((F.col("l_shipdate") >= day("1996-01-01")) & (F.col("l_shipdate") < day("1997-01-01")) & F.col("l_discount").between(0.05, 0.07) & (F.col("l_quantity") < 24))
    return lines.agg(_total(money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)"), "revenue"))


@query(f"""select a.n_name as supp_nation, b.n_name as cust_nation, year(l_shipdate) as l_year, cast(sum({REVENUE}) as double) as revenue from supplier join lineitem on s_suppkey = l_suppkey
join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join nation a on s_nationkey = a.n_nationkey join nation b on c_nationkey = b.n_nationkey
where ((a.n_name = 'NATION_1' and b.n_name = 'NATION_2') or (a.n_name = 'NATION_2' and b.n_name = 'NATION_1')) and l_shipdate between timestamp '1996-01-01' and timestamp '1999-12-31' group by 1, 2, 3""")
def tpch_q7(spark, d):
    two = t(spark, d, "nation").filter(F.col("n_name").isin("NATION_1", "NATION_2"))
    sellers = t(spark, d, "supplier").join(two, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("supp_nation"))
    buyers = t(spark, d, "customer").join(two, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("cust_nation"))
    lines = t(spark, d, "lineitem").filter(F.col("l_shipdate").between(day("1996-01-01"), day("1999-12-31"))).join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
    bought = t(spark, d, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "cust_nation")
    both = lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).filter("supp_nation <> cust_nation")
    return both.groupBy("supp_nation", "cust_nation", F.year("l_shipdate").alias("l_year")).agg(_total(revenue(), "revenue"))


@query(f"""select o_year, cast(sum(case when nation = 'NATION_2' then v else 0 end) as double) / cast(sum(v) as double) as mkt_share from (
select year(o_orderdate) as o_year, {REVENUE} as v, b.n_name as nation from part join lineitem on p_partkey = l_partkey join supplier on s_suppkey = l_suppkey join orders on o_orderkey = l_orderkey
join customer on c_custkey = o_custkey join nation a on c_nationkey = a.n_nationkey join region on a.n_regionkey = r_regionkey join nation b on s_nationkey = b.n_nationkey
where r_name = 'AMERICA' and o_orderdate between timestamp '1996-01-01' and timestamp '1999-12-31' and p_type = 'ECONOMY') x group by 1""")
def tpch_q8(spark, d):
    america = t(spark, d, "nation").join(t(spark, d, "region").filter("r_name = 'AMERICA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = t(spark, d, "customer").join(america, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    orders = t(spark, d, "orders").filter(F.col("o_orderdate").between(day("1996-01-01"), day("1999-12-31"))).join(people, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    lines = t(spark, d, "lineitem").join(t(spark, d, "part").filter("p_type = 'ECONOMY'"), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    sellers = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    all_ = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
    own = F.sum(F.when(F.col("n_name") == "NATION_2", revenue()).otherwise(0)).cast("double")
    return all_.groupBy(F.year("o_orderdate").alias("o_year")).agg((own / F.sum(revenue()).cast("double")).alias("mkt_share"))


@query(f"""select n_name as nation, year(o_orderdate) as o_year, cast(sum({REVENUE}) as double) as profit from part join lineitem on p_partkey = l_partkey join supplier on s_suppkey = l_suppkey
join orders on o_orderkey = l_orderkey join nation on s_nationkey = n_nationkey where p_name like '%ring%' group by 1, 2""")
def tpch_q9(spark, d):
    lines = t(spark, d, "lineitem").join(t(spark, d, "part").filter(F.col("p_name").like("%ring%")), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    sellers = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("nation"))
    both = lines.join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
    return both.groupBy("nation", F.year("o_orderdate").alias("o_year")).agg(_total(revenue(), "profit"))


@query(f"""select c_custkey, c_name, cast(sum({REVENUE}) as double) as revenue, n_name from customer join orders on c_custkey = o_custkey join lineitem on l_orderkey = o_orderkey join nation on c_nationkey = n_nationkey
where o_orderdate >= timestamp '1997-10-01' and o_orderdate < timestamp '1998-01-01' and l_returnflag = 'R' group by 1, 2, 4 order by revenue desc, c_custkey limit 20""")
def tpch_q10(spark, d):
    quarter = t(spark, d, "orders").filter((F.col("o_orderdate") >= day("1997-10-01")) & (F.col("o_orderdate") < day("1998-01-01")))
    back = t(spark, d, "lineitem").filter("l_returnflag = 'R'").join(quarter, F.col("l_orderkey") == F.col("o_orderkey"))
    sums = back.groupBy("o_custkey").agg(_total(revenue(), "revenue"))
    people = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return sums.join(people, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name", "revenue", "n_name").orderBy(F.col("revenue").desc(), "c_custkey").limit(20)


@query(f"""with g as (select ps_partkey, sum(cast(ps_cost as decimal(12,2)) * ps_qty) as v from ({_BRIDGE}) ps join supplier on s_suppkey = ps_suppkey where s_nationkey = 7 group by 1)
select ps_partkey, cast(v as double) as v from g where cast(v as double) > (select cast(sum(v) as double) * 0.001 from g)""")
def tpch_q11(spark, d):
    own = _bridge(t(spark, d, "lineitem").join(t(spark, d, "supplier").filter("s_nationkey = 7"), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi"))
    value = own.groupBy("ps_partkey").agg(_total(money("ps_cost") * F.col("ps_qty"), "v"))
    total = own.agg((F.sum(money("ps_cost") * F.col("ps_qty")).cast("double") * 0.001).alias("m"))
    return value.filter(F.col("v") > total.scalar())


@query("""select l_returnflag, cast(sum(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1 else 0 end) as bigint) as high, cast(sum(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 0 else 1 end) as bigint) as low
from orders join lineitem on o_orderkey = l_orderkey where l_shipdate - o_orderdate > interval 60 day and l_shipdate >= timestamp '1997-01-01' and l_shipdate < timestamp '1998-01-01' group by 1""")
def tpch_q12(spark, d):
    lines = t(spark, d, "lineitem").filter((F.col("l_shipdate") >= day("1997-01-01")) & (F.col("l_shipdate") < day("1998-01-01")))
    late = lines.join(t(spark, d, "orders"), (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate") + F.expr("interval 60 days")))
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return late.groupBy("l_returnflag").agg(F.count_if(urgent).alias("high"), F.count_if(~urgent).alias("low"))


@query("""select c_count, count(*) as custdist from (select c_custkey, count(o_orderkey) as c_count from customer left join orders on c_custkey = o_custkey and o_orderstatus <> 'P' group by 1) x group by 1""")
def tpch_q13(spark, d):
    counted = t(spark, d, "orders").filter("o_orderstatus <> 'P'").groupBy("o_custkey").agg(F.count("*").alias("n"))
    each = t(spark, d, "customer").join(counted, F.col("c_custkey") == F.col("o_custkey"), "left")
    return each.groupBy(F.coalesce("n", F.lit(0).cast("bigint")).alias("c_count")).agg(F.count("*").alias("custdist"))


@query(f"""select 100.0 * cast(sum(case when p_type like 'PROMO%' then {REVENUE} else 0 end) as double) / cast(sum({REVENUE}) as double) as promo from lineitem join part on l_partkey = p_partkey
where l_shipdate >= timestamp '1997-09-01' and l_shipdate < timestamp '1997-10-01'""")
def tpch_q14(spark, d):
    lines = t(spark, d, "lineitem").filter((F.col("l_shipdate") >= day("1997-09-01")) & (F.col("l_shipdate") < day("1997-10-01"))).join(t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    promo = F.sum(F.when(F.col("p_type").like("PROMO%"), revenue()).otherwise(0)).cast("double")
    return lines.agg((F.lit(100.0) * promo / F.sum(revenue()).cast("double")).alias("promo"))


@query(f"""with r as (select l_suppkey, sum({REVENUE}) as v from lineitem where l_shipdate >= timestamp '1997-01-01' and l_shipdate < timestamp '1997-04-01' group by 1)
select s_suppkey, s_name, cast(v as double) as total from supplier join r on s_suppkey = l_suppkey where v = (select max(v) from r)""")
def tpch_q15(spark, d):
    sums = t(spark, d, "lineitem").filter((F.col("l_shipdate") >= day("1997-01-01")) & (F.col("l_shipdate") < day("1997-04-01"))).groupBy("l_suppkey").agg(F.sum(revenue()).alias("v"))
    best = sums.filter(F.col("v") == sums.agg(F.max("v")).scalar())
    return t(spark, d, "supplier").join(best, F.col("s_suppkey") == F.col("l_suppkey")).select("s_suppkey", "s_name", F.col("v").cast("double").alias("total"))


@query(f"""select p_brand, p_type, p_size, count(distinct ps_suppkey) as n from ({_BRIDGE}) ps join part on p_partkey = ps_partkey where p_brand <> 'Brand#5' and p_type not like 'PROMO%' and p_size in (49, 14, 23, 45)
and ps_suppkey not in (select s_suppkey from supplier where s_acctbal < 0) group by 1, 2, 3""")
def tpch_q16(spark, d):
    parts = t(spark, d, "part").filter((F.col("p_brand") != "Brand#5") & ~F.col("p_type").like("PROMO%") & F.col("p_size").isin(49, 14, 23, 45))
    good = t(spark, d, "lineitem").join(t(spark, d, "supplier").filter("s_acctbal < 0"), F.col("l_suppkey") == F.col("s_suppkey"), "left_anti")
    return good.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "p_type", "p_size").agg(F.count_distinct("l_suppkey").alias("n"))


@query("""select cast(sum(cast(l_extendedprice as decimal(12,2))) as double) / 7.0 as yearly from lineitem join part on p_partkey = l_partkey where p_brand = 'Brand#23'
and cast(l_quantity as decimal(12,2)) * 5 * (select count(*) from lineitem x where x.l_partkey = p_partkey) < (select sum(cast(l_quantity as decimal(12,2))) from lineitem y where y.l_partkey = p_partkey) * 2""")
def tpch_q17(spark, d):
    brand = t(spark, d, "part").filter("p_brand = 'Brand#23'").select("p_partkey")
    lines = t(spark, d, "lineitem").join(brand, F.col("l_partkey") == F.col("p_partkey"))
    same = W.partitionBy("p_partkey")
    each = lines.select("p_partkey", "l_quantity", "l_extendedprice").withColumns({"s": F.sum(money("l_quantity")).over(same), "n": F.count("*").over(same)})
    small = each.filter(money("l_quantity") * 5 * F.col("n") < F.col("s") * 2)
    return small.agg((F.sum(money("l_extendedprice")).cast("double") / 7.0).alias("yearly"))


@query("""select c_name, c_custkey, o_orderkey, o_totalprice, cast(sum(cast(l_quantity as decimal(12,2))) as double) as qty from customer join orders on c_custkey = o_custkey join lineitem on o_orderkey = l_orderkey
where o_orderkey in (select l_orderkey from lineitem group by 1 having sum(l_quantity) > 250) group by 1, 2, 3, 4""")
def tpch_q18(spark, d):
    big = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(money("l_quantity")).alias("q")).filter("q > 250")
    orders = t(spark, d, "orders").join(big, F.col("o_orderkey") == F.col("l_orderkey"))
    return orders.join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_name", "c_custkey", "o_orderkey", "o_totalprice", F.col("q").cast("double").alias("qty"))


@query(f"""select cast(sum({REVENUE}) as double) as revenue from lineitem join part on p_partkey = l_partkey where (p_brand = 'Brand#12' and l_quantity between 1 and 11 and p_size between 1 and 5)
or (p_brand = 'Brand#23' and l_quantity between 10 and 20 and p_size between 1 and 10) or (p_brand = 'Brand#3' and l_quantity between 20 and 30 and p_size between 1 and 15)""")
def tpch_q19(spark, d):
    one = lambda b, lo, hi, size: (F.col("p_brand") == b) & F.col("l_quantity").between(lo, hi) & F.col("p_size").between(1, size)
    wanted = one("Brand#12", 1, 11, 5) | one("Brand#23", 10, 20, 10) | one("Brand#3", 20, 30, 15)
    return t(spark, d, "lineitem").join(t(spark, d, "part"), (F.col("l_partkey") == F.col("p_partkey")) & wanted).agg(_total(revenue(), "revenue"))


@query(f"""select s_name from supplier where s_nationkey < 12 and s_suppkey in (select ps_suppkey from ({_BRIDGE}) ps where ps_partkey in (select p_partkey from part where p_name like '%ring%')
and ps_qty > (select 0.5 * sum(l_quantity) from lineitem where l_partkey = ps_partkey and l_suppkey = ps_suppkey and l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1998-01-01'))""")
def tpch_q20(spark, d):
    parts = t(spark, d, "part").filter(F.col("p_name").like("%ring%"))
    lines = t(spark, d, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    within = (F.col("l_shipdate") >= day("1996-01-01")) & (F.col("l_shipdate") < day("1998-01-01"))
    sums = lines.groupBy("l_partkey", "l_suppkey").agg(F.sum(money("l_quantity")).alias("q"), F.sum(F.when(within, money("l_quantity"))).alias("w"))
    enough = sums.filter("q * 2 > w").select("l_suppkey")
    return t(spark, d, "supplier").filter("s_nationkey < 12").join(enough, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi").select("s_name")


@query("""with l as (select l_orderkey, l_suppkey, max(case when l_shipdate > o_orderdate + interval 60 day then 1 else 0 end) as late from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'F' group by 1, 2)
select s_name, count(*) as numwait from supplier join l a on s_suppkey = a.l_suppkey where a.late = 1 and s_nationkey = 3 and exists (select 1 from l b where b.l_orderkey = a.l_orderkey and b.l_suppkey <> a.l_suppkey)
and not exists (select 1 from l b where b.l_orderkey = a.l_orderkey and b.l_suppkey <> a.l_suppkey and b.late = 1) group by 1""")
def tpch_q21(spark, d):
    lines = t(spark, d, "lineitem").join(t(spark, d, "orders").filter("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
    late = F.max((F.col("l_shipdate") > F.col("o_orderdate") + F.expr("interval 60 days")).cast("int"))
    each = lines.groupBy("l_orderkey", "l_suppkey").agg(late.alias("late"))
    # one aggregate says of each order how many sellers and how many late ones it has
    alone = each.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("late").alias("k"), F.max(F.when(F.col("late") == 1, F.col("l_suppkey"))).alias("who")).filter("n > 1 and k = 1")
    sellers = t(spark, d, "supplier").filter("s_nationkey = 3")
    return alone.join(sellers, F.col("who") == F.col("s_suppkey")).groupBy("s_name").agg(F.count("*").alias("numwait"))


@query("""select c_nationkey, count(*) as numcust, cast(sum(cast(c_acctbal as decimal(12,2))) as double) as total from customer where c_nationkey in (1, 3, 5, 7, 11, 13, 17)
and cast(c_acctbal as decimal(12,2)) > (select sum(cast(c_acctbal as decimal(12,2))) / count(*) from customer where c_acctbal > 0 and c_nationkey in (1, 3, 5, 7, 11, 13, 17))
and not exists (select 1 from orders where o_custkey = c_custkey and o_orderdate >= timestamp '2001-01-01') group by 1""")
def tpch_q22(spark, d):
    some = t(spark, d, "customer").filter(F.col("c_nationkey").isin(1, 3, 5, 7, 11, 13, 17))
    mean = some.filter("c_acctbal > 0").agg(F.sum(money("c_acctbal")).cast("double") / F.count("*"))
    late = t(spark, d, "orders").filter(F.col("o_orderdate") >= day("2001-01-01"))
    idle = some.filter(money("c_acctbal").cast("double") > mean.scalar()).join(late, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    return idle.groupBy("c_nationkey").agg(F.count("*").alias("numcust"), _total(money("c_acctbal"), "total"))
