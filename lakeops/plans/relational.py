"""Joins, aggregates, set operations and extremes over the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators import aggs as A
from lakeops.operators import joins as J
from lakeops.operators import sets as S
from lakeops.registry import Tables, query


def money(name: str):
    """A double amount as decimal(18,2), so that sums are exact."""
    return F.col(name).cast("decimal(18,2)")


REV_SQL = "cast(l_extendedprice as decimal(18,2))"


def price_history(t: Tables):
    """Three price versions of each part: open start to 1997, to 1999, and to the open end."""
    steps = F.array(
        F.struct(F.lit("1900-01-01").cast("date").alias("valid_from"), F.lit("1997-01-01").cast("date").alias("valid_to"), F.lit("0.90").cast("decimal(3,2)").alias("f")),
        F.struct(F.lit("1997-01-01").cast("date").alias("valid_from"), F.lit("1999-01-01").cast("date").alias("valid_to"), F.lit("1.00").cast("decimal(3,2)").alias("f")),
        F.struct(F.lit("1999-01-01").cast("date").alias("valid_from"), F.lit("9999-12-31").cast("date").alias("valid_to"), F.lit("1.10").cast("decimal(3,2)").alias("f")))
    versions = t.part.select(F.col("p_partkey").alias("l_partkey"), money("p_retailprice").alias("base"), F.explode(steps).alias("v"))
    return versions.select("l_partkey", "v.valid_from", "v.valid_to", (F.col("base") * F.col("v.f")).cast("decimal(18,4)").alias("unit_price"),
                           F.when(F.col("v.valid_to") == F.lit("9999-12-31").cast("date"), "Y").otherwise("N").alias("scd_active_flag"))


HIST_SQL = """hist as (select p_partkey as h_partkey, v.valid_from, v.valid_to,
  cast(cast(p_retailprice as decimal(18,2)) * v.f as decimal(18,4)) as unit_price,
  case when v.valid_to = date '9999-12-31' then 'Y' else 'N' end as scd_active_flag
 from part, (values (date '1900-01-01', date '1997-01-01', cast(0.90 as decimal(3,2))),
   (date '1997-01-01', date '1999-01-01', cast(1.00 as decimal(3,2))),
   (date '1999-01-01', date '9999-12-31', cast(1.10 as decimal(3,2)))) v(valid_from, valid_to, f))"""


# ---- joins

@query("join_star_inner", f"""
select n_name, count(*) as n_lines, cast(sum({REV_SQL}) as decimal(28,2)) as revenue
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by n_name""")
def _(t: Tables):
    joined = J.join_star_inner(
        t.lineitem.select("l_orderkey", "l_extendedprice"),
        [(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"),
         (t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"),
         (t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")])
    return A.agg_group(joined, ["n_name"], [F.count(F.lit(1)).alias("n_lines"), F.sum(money("l_extendedprice")).alias("revenue")])


@query("join_left_default", """
select c_custkey, coalesce(n, 0) as n_urgent, coalesce(last_day, date '9999-12-31') as last_day
from customer left join (select o_custkey, nullif(count(*) filter (o_orderpriority = '1-URGENT' and o_orderstatus = 'F'), 0) as n,
  cast(max(o_orderdate) filter (o_orderpriority = '1-URGENT' and o_orderstatus = 'F') as date) as last_day from orders group by 1) on c_custkey = o_custkey""")
def _(t: Tables):
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.nullif(F.count_if(urgent), F.lit(0)).alias("n_urgent"), F.max(F.when(urgent, F.col("o_orderdate"))).cast("date").alias("last_day"))
    return J.join_left_default(t.customer.select("c_custkey"), per, "c_custkey", defaults={"n_urgent": 0, "last_day": "9999-12-31"})


@query("join_full_coalesce_keys", """
with a as (select case when o_orderpriority = '1-URGENT' then -o_custkey - 1 else o_custkey end as custkey, count(*) as n_orders, nullif(count(*) filter (o_orderstatus = 'O'), 0) as n_open from orders group by 1),
b as (select case when c_mktsegment = 'BUILDING' then c_custkey + 1000000000 else c_custkey end as custkey, c_mktsegment as segment from customer)
select coalesce(a.custkey, b.custkey) as custkey, n_orders, n_open, segment from a full join b on a.custkey = b.custkey""")
def _(t: Tables):
    # Renamed keys make rows without a partner on both sides.
    a = t.orders.groupBy(F.expr("case when o_orderpriority = '1-URGENT' then -o_custkey - 1 else o_custkey end").alias("custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.nullif(F.count_if(F.col("o_orderstatus") == "O"), F.lit(0)).alias("n_open"))
    b = t.customer.selectExpr("case when c_mktsegment = 'BUILDING' then c_custkey + 1000000000 else c_custkey end as custkey", "c_mktsegment as segment")
    return J.join_full_coalesce_keys(a, b, ["custkey"])


_ALL_JOINS = {"inner": "join", "left": "left join", "right": "right join", "full": "full join"}


@query("join_apply", """
with c as (select case when c_mktsegment = 'BUILDING' then -c_custkey - 1 else c_custkey end as c_custkey, c_nationkey from customer),
o as (select case when o_orderpriority = '1-URGENT' then o_custkey + 1000000000 else o_custkey end as o_custkey, count(*) as n from orders group by 1)
select 'inner' as how, c_custkey, o_custkey, n from c join o on c_custkey = o_custkey
union all select 'left', c_custkey, o_custkey, n from c left join o on c_custkey = o_custkey
union all select 'right', c_custkey, o_custkey, n from c right join o on c_custkey = o_custkey
union all select 'full', c_custkey, o_custkey, n from c full join o on c_custkey = o_custkey
union all select 'semi', c_custkey, null, null from c where c_custkey in (select o_custkey from o)
union all select 'anti', c_custkey, null, null from c where c_custkey not in (select o_custkey from o)
union all select 'cross', c_custkey, null, n from c, (select cast(sum(n) as bigint) as n from o)""")
def _(t: Tables):
    # Renamed keys make rows without a partner on both sides.
    c = t.customer.selectExpr("case when c_mktsegment = 'BUILDING' then -c_custkey - 1 else c_custkey end as c_custkey", "c_nationkey")
    o = t.orders.selectExpr("case when o_orderpriority = '1-URGENT' then o_custkey + 1000000000 else o_custkey end as o_custkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    on, cols = "l.c_custkey = r.o_custkey", ["l.c_custkey", "r.o_custkey", "r.n"]
    both = [J.join_apply(c, o, on_sql=on, how=h, select_sql=[f"'{h}' as how", *cols])
            for h in _ALL_JOINS]
    left_only = ["cast(null as bigint) as o_custkey", "cast(null as bigint) as n"]
    both += [J.join_apply(c, o, on_sql=on, how=f"left_{h}", select_sql=[f"'{h}' as how", "c_custkey", *left_only]) for h in ("semi", "anti")]
    total = J.join_scalar_params(c, o.agg(F.sum("n").cast("bigint").alias("n")))
    both.append(total.selectExpr("'cross' as how", "c_custkey", "cast(null as bigint) as o_custkey", "n"))
    return S.union_all_rows(*both)


@query("join_scalar_params", """
with p as (select cast(max(o_orderdate) as date) as last_day, cast(min(o_orderdate) as date) as first_day from orders)
select o_orderkey, last_day - cast(o_orderdate as date) as age, first_day from orders, p where cast(o_orderdate as date) between last_day - 365 and last_day""")
def _(t: Tables):
    p = t.orders.agg(F.max("o_orderdate").cast("date").alias("last_day"), F.min("o_orderdate").cast("date").alias("first_day"))
    day = F.col("o_orderdate").cast("date")
    o = J.join_scalar_params(t.orders.select("o_orderkey", "o_orderdate"), p)
    return o.where(day.between(F.date_sub("last_day", 365), F.col("last_day"))).select(
        "o_orderkey", F.date_diff("last_day", day).cast("bigint").alias("age"), "first_day")


@query("cross_join_grid", """
with b as (select cast(min(l_shipdate) as date) as d1, cast(max(l_shipdate) as date) as d2 from lineitem),
days as (select cast(unnest(generate_series(d1, d2, interval 1 day)) as date) as day from b),
n as (select s_suppkey from supplier), s as (select l_suppkey, cast(l_shipdate as date) as day, count(*) as n from lineitem group by 1, 2)
select s_suppkey, days.day, coalesce(s.n, 0) as n_lines from n cross join days left join s on s_suppkey = l_suppkey and days.day = s.day""")
def _(t: Tables):
    bounds = t.lineitem.agg(F.min("l_shipdate").cast("date").alias("first_day"), F.max("l_shipdate").cast("date").alias("last_day"))
    grid = J.cross_join_grid(t.supplier.select("s_suppkey"), bounds)
    shipped = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey"), F.col("l_shipdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_lines"))
    return J.join_left_default(grid, shipped, ["s_suppkey", "day"], defaults={"n_lines": 0})


@query("join_validity_half_open", f"""
with {HIST_SQL}
select l_returnflag, valid_from, count(*) as n, cast(sum(unit_price * cast(l_quantity as decimal(18,2))) as decimal(38,6)) as amount
from lineitem join hist on l_partkey = h_partkey and valid_from <= cast(l_shipdate as date) and cast(l_shipdate as date) < valid_to
group by 1, 2""")
def _(t: Tables):
    lines = t.lineitem.select("l_partkey", "l_returnflag", "l_quantity", F.col("l_shipdate").cast("date").alias("day"))
    priced = J.join_validity_half_open(lines, price_history(t), on=["l_partkey"], date="day", start="valid_from", end="valid_to")
    return priced.groupBy("l_returnflag", "valid_from").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("unit_price") * money("l_quantity")).cast("decimal(38,6)").alias("amount"))


@query("join_validity_closed", f"""
with {HIST_SQL}
select valid_from, valid_to, count(*) as n, sum(case when cast(l_shipdate as date) in (valid_from, valid_to) then 1 else 0 end)::bigint as on_boundary
from lineitem join hist on l_partkey = h_partkey and cast(l_shipdate as date) between valid_from and valid_to group by 1, 2""")
def _(t: Tables):
    lines = t.lineitem.select("l_partkey", F.col("l_shipdate").cast("date").alias("day"))
    priced = J.join_validity_closed(lines, price_history(t), on=["l_partkey"], date="day", start="valid_from", end="valid_to")
    edge = F.col("day").isin(F.col("valid_from"), F.col("valid_to"))
    return priced.groupBy("valid_from", "valid_to").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(edge, 1).otherwise(0)).alias("on_boundary"))


VERSIONS_SQL = """days as (select distinct o_orderpriority as p, cast(o_orderdate as date) as d from orders),
ver as (select p, d as valid_from, coalesce(lead(d) over (partition by p order by d), date '9999-12-31') as valid_to from days)"""


@query("join_validity_bucketed", f"""
with {VERSIONS_SQL}, f as (select o_orderpriority as p, cast(l_shipdate as date) as day, l_quantity from lineitem join orders on o_orderkey = l_orderkey)
select f.p, valid_from, count(*) as n, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(38,2)) as quantity from f left join ver on ver.p = f.p and valid_from <= day and day < valid_to group by 1, 2""")
def _(t: Tables):
    """Lines look up one of the some 2,400 versions that each of five keys has."""
    days = t.orders.select(F.col("o_orderpriority").alias("p"), F.col("o_orderdate").cast("date").alias("valid_from")).distinct()
    # A key has a version a day at most, so one task can hold its days.
    following = F.lead("valid_from").over(Window.partitionBy("p").orderBy("valid_from"))
    versions = days.select("p", "valid_from", F.coalesce(following, F.lit("9999-12-31").cast("date")).alias("valid_to"))
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("p"))
    lines = t.lineitem.select("l_orderkey", F.col("l_shipdate").cast("date").alias("day"), "l_quantity").join(orders, "l_orderkey")
    priced = J.join_validity_bucketed(lines, versions, on=["p"], date="day", start="valid_from", end="valid_to", how="left")
    return priced.groupBy("p", "valid_from").agg(F.count(F.lit(1)).alias("n"), F.sum(money("l_quantity")).cast("decimal(38,2)").alias("quantity"))


@query("join_active_only", f"""
with {HIST_SQL}
select l_linestatus, count(*) as n, cast(sum(unit_price) as decimal(38,4)) as prices from lineitem join hist on l_partkey = h_partkey
where scd_active_flag = 'Y' group by 1""")
def _(t: Tables):
    joined = J.join_active_only(t.lineitem.select("l_partkey", "l_linestatus"), price_history(t), on="l_partkey", flag="scd_active_flag")
    return joined.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("unit_price").cast("decimal(38,4)").alias("prices"))


@query("join_null_safe", """
with a as (select o_orderkey, nullif(o_orderstatus, 'P') as status, case when o_orderkey % 5 = 0 then null else o_custkey % 3 end as grp from orders),
b as (select nullif(o_orderstatus, 'P') as status, case when o_orderkey % 5 = 0 then null else o_custkey % 3 end as grp, count(*) as n from orders group by 1, 2)
select o_orderkey, a.status, a.grp, n from a join b on a.status is not distinct from b.status and a.grp is not distinct from b.grp""")
def _(t: Tables):
    a = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
                        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey") % 3).alias("grp"))
    return J.join_null_safe(a, a.groupBy("status", "grp").agg(F.count(F.lit(1)).alias("n")), ["status", "grp"], how="inner")


@query("join_expression_keys", """
select o_orderkey, cast(o_orderdate as date) as day, n as shipped_that_day
from orders left join (select cast(l_shipdate as date) as d, count(*) as n from lineitem group by 1) on cast(o_orderdate as date) = d""")
def _(t: Tables):
    shipped = t.lineitem.groupBy("l_shipdate").agg(F.count(F.lit(1)).alias("shipped_that_day"))
    joined = J.join_expression_keys(t.orders.select("o_orderkey", "o_orderdate"), shipped, left_key="date(o_orderdate)", right_key="date(l_shipdate)", how="left")
    return joined.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "shipped_that_day")


@query("join_branch_by_value", """
with s as (select o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as spend from orders where o_orderpriority = '1-URGENT' group by 1),
w as (select o_custkey, cast(max(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as spend from orders where o_orderpriority <> '1-URGENT' group by 1)
select o_orderkey, o_orderstatus, case when o_orderstatus = 'F' then s.spend when o_orderstatus = 'O' then w.spend end as spend
from orders o left join s on o.o_custkey = s.o_custkey and o_orderstatus = 'F' left join w on o.o_custkey = w.o_custkey and o_orderstatus = 'O'""")
def _(t: Tables):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    f = t.orders.where(urgent).groupBy("o_custkey").agg(F.sum(money("o_totalprice")).cast("decimal(28,2)").alias("spend"))
    o = t.orders.where(~urgent).groupBy("o_custkey").agg(F.max(money("o_totalprice")).cast("decimal(28,2)").alias("spend"))
    base = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return J.join_branch_by_value(base, {"F": f, "O": o}, on=["o_custkey"], channel="o_orderstatus").select("o_orderkey", "o_orderstatus", "spend")


@query("join_previous_day_self", """
with d as (select distinct user_id, cast(ts as date) as day, 5 + cast(user_id % 3 as int) as days_in_stock from events)
select d.user_id, d.day, coalesce(p.days_in_stock, 0) + 1 as days_in_stock from d left join d p on d.user_id = p.user_id and d.day = p.day + 1""")
def _(t: Tables):
    days = t.events.select("user_id", F.to_date("ts").alias("day"), (F.lit(5) + (F.col("user_id") % 3).cast("int")).alias("days_in_stock")).distinct()
    return J.join_previous_day_self(days, keys=["user_id"], date="day", counter="days_in_stock")


@query("join_latest_snapshot", """
with s as (select c_nationkey as grp, o_orderdate as run, o_orderkey from orders join customer on o_custkey = c_custkey)
select s.grp, s.run, s.o_orderkey from s join (select grp, max(run) as run from s group by 1) m on s.grp = m.grp and s.run = m.run""")
def _(t: Tables):
    s = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("grp"), F.col("o_orderdate").alias("run"), "o_orderkey")
    return J.join_latest_snapshot(s, s, key=["grp"], by="run").select("grp", "run", "o_orderkey")


@query("semi_join_in", "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_totalprice > 400000)")
def _(t: Tables):
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return J.semi_join_in(t.customer.select("c_custkey", "c_name"), big, ["c_custkey"])


@query("anti_join_not_in", """
select 'plain' as list, c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 400000)
union all select 'with null', c_custkey from customer where c_custkey not in (select nullif(o_custkey, 1) from orders)
union all select 'empty', c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice < 0)""")
def _(t: Tables):
    c, o = t.customer.select("c_custkey"), t.orders
    key = F.col("o_custkey").alias("c_custkey")
    lists = {
        "plain": o.where("o_totalprice > 400000").select(key),
        "with null": o.select(F.nullif("o_custkey", F.lit(1)).alias("c_custkey")),
        "empty": o.where("o_totalprice < 0").select(key)}
    return S.union_all_rows(*[J.anti_join_not_in(c, o, "c_custkey").select(F.lit(n).alias("list"), "c_custkey") for n, o in lists.items()])


@query("anti_join_not_exists", "select p_partkey, p_brand from part where not exists (select 1 from lineitem where l_partkey = p_partkey and l_returnflag = 'R' and l_quantity > 25)")
def _(t: Tables):
    returned = t.lineitem.where("l_returnflag = 'R' and l_quantity > 25").select(F.col("l_partkey").alias("p_partkey"))
    return J.anti_join_not_exists(t.part.select("p_partkey", "p_brand"), returned, "p_partkey")


CUSTOMER_V2_SQL = """v2 as (select c_custkey, c_name, case when c_custkey % 4 = 0 then c_nationkey + 1 when c_custkey % 10 = 3 then null else c_nationkey end as c_nationkey,
  c_mktsegment from customer where c_acctbal >= 0 union all select c_custkey + 10000000000, c_name || ' new', c_nationkey, c_mktsegment from customer where c_acctbal > 9000)"""


def customer_v2(t: Tables):
    """A second delivery of the customers: some moved, some without a nation, some gone, some new."""
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    moved = F.when(F.col("c_custkey") % 4 == 0, F.col("c_nationkey") + 1).when(F.col("c_custkey") % 10 == 3, F.lit(None)).otherwise(F.col("c_nationkey"))
    kept = t.customer.where("c_acctbal >= 0").select(*cols).withColumn("c_nationkey", moved)
    fresh = t.customer.where("c_acctbal > 9000").select(*cols).withColumns({"c_custkey": F.col("c_custkey") + F.lit(10000000000), "c_name": F.concat("c_name", F.lit(" new"))})
    return kept.unionByName(fresh)


@query("anti_left_join_null", f"""
with {CUSTOMER_V2_SQL} select v2.* from v2 where not exists (select 1 from customer c where c.c_custkey is not distinct from v2.c_custkey
  and c.c_name is not distinct from v2.c_name and c.c_nationkey is not distinct from v2.c_nationkey and c.c_mktsegment is not distinct from v2.c_mktsegment)""")
def _(t: Tables):
    return J.anti_left_join_null(customer_v2(t), t.customer, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


@query("lookup_map", "select c_custkey, c_nationkey, n_name as nation from customer left join (select * from nation where n_regionkey <> 2) on c_nationkey = n_nationkey")
def _(t: Tables):
    names = t.nation.where("n_regionkey <> 2")
    return J.lookup_map(t.customer.select("c_custkey", "c_nationkey"), names, key="c_nationkey", map_key="n_nationkey", value="n_name", name="nation")


@query("status_cascade_lookup", """
with basic as (select p_partkey, cast(p_retailprice as decimal(18,2)) as price from part where p_size <= 15),
average as (select l_partkey as p_partkey, cast(max(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as price from lineitem where l_quantity < 10 group by 1)
select part.p_partkey, case when basic.p_partkey is not null then basic.price when average.p_partkey is not null then average.price else cast(0.01 as decimal(18,2)) end as price,
 case when basic.p_partkey is not null then 'Basic' when average.p_partkey is not null then 'Average' else 'Default' end as price_source
from part left join basic on part.p_partkey = basic.p_partkey left join average on part.p_partkey = average.p_partkey""")
def _(t: Tables):
    basic = t.part.where("p_size <= 15").select("p_partkey", money("p_retailprice").alias("price"))
    average = t.lineitem.where("l_quantity < 10").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max(money("l_extendedprice")).alias("price"))
    return J.status_cascade_lookup(t.part.select("p_partkey"), [("Basic", basic), ("Average", average)], key=["p_partkey"],
                                   value="price", default="0.01", label="price_source")


# ---- aggregates

@query("agg_group", f"""
select l_returnflag, l_linestatus, count(*) as n, cast(sum({REV_SQL}) as decimal(28,2)) as revenue, min(l_quantity) as min_qty, max(l_quantity) as max_qty,
 cast(sum(cast(l_quantity as decimal(18,2))) as double) / count(*) as avg_qty from lineitem group by 1, 2""")
def _(t: Tables):
    return A.agg_group(t.lineitem, ["l_returnflag", "l_linestatus"], [
        F.count(F.lit(1)).alias("n"), F.sum(money("l_extendedprice")).alias("revenue"), F.min("l_quantity").alias("min_qty"),
        F.max("l_quantity").alias("max_qty"), (F.sum(money("l_quantity")).cast("double") / F.count(F.lit(1))).alias("avg_qty")])


@query("agg_recipe", "select o_orderstatus, o_orderpriority, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as total from orders group by 1, 2")
def _(t: Tables):
    return A.agg_recipe(t.orders, ["o_orderstatus", "o_orderpriority"], ["count(*) as n", "sum(cast(o_totalprice as decimal(18,2))) as total"])


@query("agg_count_distinct", "select l_returnflag, count(distinct l_orderkey) as n_orders, count(distinct l_partkey) as n_parts from lineitem group by 1")
def _(t: Tables):
    return A.agg_count_distinct(t.lineitem, ["l_returnflag"], {"n_orders": "l_orderkey", "n_parts": "l_partkey"})


@query("agg_conditional_sum", """
with e as (select o_orderstatus, cast(o_orderdate as date) + 180 as expiry from orders)
select o_orderstatus, sum(case when expiry <= date '2001-08-01' then 1 else 0 end)::bigint as expired,
 sum(case when expiry between date '2001-08-02' and date '2001-08-15' then 1 else 0 end)::bigint as expiring_14d,
 sum(case when expiry between date '2001-08-02' and date '2001-09-05' then 1 else 0 end)::bigint as expiring_5w from e group by 1""")
def _(t: Tables):
    e = t.orders.select("o_orderstatus", F.date_add(F.col("o_orderdate").cast("date"), 180).alias("expiry"))
    day = "date '2001-08-01'"
    return A.agg_conditional_sum(e, ["o_orderstatus"], {
        "expired": (f"expiry <= {day}", "1"),
        "expiring_14d": (f"expiry between {day} + 1 and {day} + 14", "1"),
        "expiring_5w": (f"expiry between {day} + 1 and {day} + 35", "1")})


@query("agg_conditional_distinct", """
select l_returnflag, count(distinct case when l_quantity < 10 then l_partkey end) as small_parts,
 count(distinct case when l_quantity between 10 and 30 then l_partkey end) as mid_parts, count(distinct case when l_quantity > 30 then l_partkey end) as big_parts
from lineitem group by 1""")
def _(t: Tables):
    return A.agg_conditional_distinct(t.lineitem, ["l_returnflag"], "l_partkey", {
        "small_parts": "l_quantity < 10", "mid_parts": "l_quantity between 10 and 30", "big_parts": "l_quantity > 30"})


@query("agg_having", "select o_custkey, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as spend from orders group by 1 having sum(cast(o_totalprice as decimal(18,2))) >= 2500000 and count(*) >= 4")
def _(t: Tables):
    return A.agg_having(t.orders, ["o_custkey"], [F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("spend")], "spend >= 2500000 and n >= 4")


@query("agg_two_level", """
select c_nationkey, count(*) as scripts, cast(sum(items) as bigint) as items, max(items) as most_items from
 (select c_nationkey, o_orderkey, count(*) as items from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey group by 1, 2) group by 1""")
def _(t: Tables):
    lines = t.lineitem.select("l_orderkey").join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    lines = lines.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    return A.agg_two_level(lines, ["c_nationkey"], ["l_orderkey"], inner_aggs=[F.count(F.lit(1)).alias("items")],
                           outer_aggs=[F.count(F.lit(1)).alias("scripts"), F.sum("items").alias("items"), F.max("items").alias("most_items")])


@query("agg_flags_max", """
select user_id, cast(ts as date) as day, max(case when event_type = 'purchase' then 'YES' end) as purchased, max(case when event_type = 'error' then 'YES' end) as failed,
 max(case when value > 50 then 'YES' end) as high_value from events group by 1, 2""")
def _(t: Tables):
    e = t.events.withColumn("day", F.to_date("ts"))
    return A.agg_flags_max(e, ["user_id", "day"], {"purchased": "event_type = 'purchase'", "failed": "event_type = 'error'", "high_value": "value > 50"})


@query("agg_ratio_percent", """
select l_linestatus, l_suppkey, cast(((20000 * r + n) // (2 * n)) / 100.0 as decimal(5,2)) as percent from
 (select l_linestatus, l_suppkey, cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as r, count(*) as n from lineitem group by 1, 2)""")
def _(t: Tables):
    return A.agg_ratio_percent(t.lineitem, ["l_linestatus", "l_suppkey"], "sum(case when l_returnflag = 'R' then 1 else 0 end)", "count(*)")


@query("agg_min_date_per_entity", "select user_id, cast(strftime(ts, '%Y%m') as int) as month_key, cast(min(ts) as date) as first_date from events where event_type = 'signup' group by 1, 2")
def _(t: Tables):
    e = t.events.where("event_type = 'signup'").withColumn("month_key", F.date_format("ts", "yyyyMM").cast("int"))
    return A.agg_min_date_per_entity(e, ["user_id", "month_key"], "ts")


@query("agg_latest_per_key", """
select 'keep' as ties, o_custkey, o_orderdate, o_orderkey from (select *, rank() over (partition by o_custkey order by o_orderdate desc) as r from orders) where r = 1
union all select 'one', o_custkey, o_orderdate, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r from orders) where r = 1""")
def _(t: Tables):
    o = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    return S.union_all_rows(*[A.agg_latest_per_key(o, ["o_custkey"], "o_orderdate", ties=k).select(F.lit(k).alias("ties"), "*") for k in ("keep", "one")])


@query("agg_extreme_then_detail", """
select distinct l_orderkey, l_shipdate, l_returnflag, l_suppkey from (select *, rank() over (partition by l_orderkey order by l_shipdate desc) as r from lineitem) where r = 1""")
def _(t: Tables):
    return A.agg_extreme_then_detail(t.lineitem, ["l_orderkey"], "l_shipdate", ["l_returnflag", "l_suppkey"])


@query("agg_total_vs_part", f"""
select week, l_suppkey, amount, cast(sum(amount) over (partition by week) as decimal(38,2)) as total_amount, n, cast(sum(n) over (partition by week) as bigint) as total_n from
 (select cast(date_trunc('week', l_shipdate) as date) as week, l_suppkey, cast(sum({REV_SQL}) as decimal(28,2)) as amount, count(*) as n from lineitem group by 1, 2)""")
def _(t: Tables):
    li = t.lineitem.select(F.date_trunc("week", "l_shipdate").cast("date").alias("week"), "l_suppkey", "l_extendedprice")
    out = A.agg_total_vs_part(li, ["week"], ["l_suppkey"], {"amount": money("l_extendedprice"), "n": F.lit(1)})
    return out.withColumn("total_amount", F.col("total_amount").cast("decimal(38,2)"))


PERIODS = [("Previous 4 Weeks", 1, 4), ("Previous 12 Weeks", 1, 12), ("Previous 52 Weeks", 1, 52), ("Prior Year", 13, 64), ("Fixed Year", 100, 151)]
PERIODS_SQL = "(values " + ", ".join(f"('{l}', {a}, {b})" for l, a, b in PERIODS) + ") p(time_period, lo, hi)"


@query("agg_rolling_periods", f"""
with w as (select cast(date_trunc('week', l_shipdate) as date) as week, dense_rank() over (order by date_trunc('week', l_shipdate) desc) as week_rank, * from lineitem)
select time_period, l_returnflag, cast(sum({REV_SQL}) as decimal(28,2)) as revenue, count(*) as n from w join {PERIODS_SQL} on week_rank between lo and hi group by 1, 2""")
def _(t: Tables):
    from lakeops.operators.windows import week_rank_desc
    li = t.lineitem.select(F.date_trunc("week", "l_shipdate").cast("date").alias("week"), "l_returnflag", "l_extendedprice")
    ranked = week_rank_desc(li, week="week", name="week_rank")
    out = A.agg_rolling_periods(ranked, PERIODS, rank="week_rank", keys=["l_returnflag"], aggs={"revenue": money("l_extendedprice"), "n": F.lit(1)})
    return out.withColumn("revenue", F.col("revenue").cast("decimal(28,2)"))


@query("agg_rolling_distinct", f"""
with w as (select dense_rank() over (order by date_trunc('week', l_shipdate) desc) as week_rank, * from lineitem)
select time_period, l_returnflag, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers, count(distinct l_orderkey) as orders from w join {PERIODS_SQL} on week_rank between lo and hi group by 1, 2""")
def _(t: Tables):
    from lakeops.operators.windows import week_rank_desc
    li = t.lineitem.select(F.date_trunc("week", "l_shipdate").cast("date").alias("week"), "l_returnflag", "l_partkey", "l_suppkey", "l_orderkey")
    return A.agg_rolling_distinct(week_rank_desc(li, week="week", name="week_rank"), PERIODS, rank="week_rank", keys=["l_returnflag"],
                                  entities={"parts": "l_partkey", "suppliers": "l_suppkey", "orders": "l_orderkey"})


@query("agg_annualise", """
select l_partkey, cast(sum(cast(l_quantity as decimal(18,2))) as double) / count(distinct date_trunc('week', l_shipdate)) * 52 as annualised from lineitem group by 1""")
def _(t: Tables):
    li = t.lineitem.select("l_partkey", F.date_trunc("week", "l_shipdate").alias("week"), money("l_quantity").alias("qty"))
    return A.agg_annualise(li, ["l_partkey"], F.col("qty"), "week")


def _bands_sql(closed: bool) -> str:
    conds = (["x < 1000", "x between 1000 and 1500", "x between 1500 and 1900", "x > 1900"] if closed
             else ["x < 1000", "x >= 1000 and x < 1500", "x >= 1500 and x < 1900", "x >= 1900"])
    cols = ", ".join(f"count(distinct case when {c} then p_partkey end) as band_{i}_count, cast(coalesce(sum(case when {c} then x end), 0) as decimal(28,2)) as band_{i}_value"
                     for i, c in enumerate(conds, 1))
    return f"select '{'closed' if closed else 'half open'}' as edges, p_brand, {cols} from (select p_brand, p_partkey, cast(p_retailprice as decimal(18,2)) as x from part) group by 2"


@query("agg_bands", _bands_sql(False) + " union all " + _bands_sql(True))
def _(t: Tables):
    p = t.part.select("p_brand", "p_partkey", money("p_retailprice").alias("x"))
    outs = []
    for closed in (False, True):
        b = A.agg_bands(p, ["p_brand"], "x", [1000, 1500, 1900], entity="p_partkey", measure=F.col("x"), closed=closed)
        b = b.withColumns({f"band_{i}_value": F.col(f"band_{i}_value").cast("decimal(28,2)") for i in range(1, 5)})
        outs.append(b.select(F.lit("closed" if closed else "half open").alias("edges"), "*"))
    return S.union_all_rows(*outs)


@query("agg_bridge", """
with y as (select c_mktsegment, o_orderpriority, cast(sum(case when year(o_orderdate) = 2000 then cast(o_totalprice as decimal(18,2)) else 0 end) as decimal(28,2)) as ty,
  cast(sum(case when year(o_orderdate) = 1999 then cast(o_totalprice as decimal(18,2)) else 0 end) as decimal(28,2)) as ly from orders join customer on o_custkey = c_custkey group by 1, 2)
select c_mktsegment, o_orderpriority, cast(ty - ly as decimal(28,2)) as amount from y union all select c_mktsegment, 'LY', cast(sum(ly) as decimal(28,2)) from y group by 1""")
def _(t: Tables):
    o = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    year = F.year("o_orderdate")
    out = A.agg_bridge(o, ["c_mktsegment"], F.when(year == 2000, money("o_totalprice")).otherwise(0), F.when(year == 1999, money("o_totalprice")).otherwise(0), kind="o_orderpriority")
    return out.withColumn("amount", F.col("amount").cast("decimal(28,2)"))


@query("agg_distribution", "select l_partkey, cast(date_trunc('month', l_shipdate) as date) as month, count(distinct l_suppkey) as distribution from lineitem group by 1, 2")
def _(t: Tables):
    return A.agg_distribution(t.lineitem.withColumn("month", F.date_trunc("month", "l_shipdate").cast("date")), ["l_partkey", "month"], "l_suppkey")


@query("distinct_rows", "select distinct l_partkey, l_suppkey from lineitem")
def _(t: Tables):
    return A.distinct_rows(t.lineitem, ["l_partkey", "l_suppkey"])


@query("dedupe_rows", "select distinct l_orderkey, l_linenumber from lineitem")
def _(t: Tables):
    return A.dedupe_rows(t.lineitem.select("l_orderkey", "l_linenumber"))


@query("dedupe_by", """
select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey) as r from lineitem) where r = 1""")
def _(t: Tables):
    return A.dedupe_by(t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("pivot_sum", """
select c_mktsegment, """ + ", ".join(f"cast(sum(case when o_orderstatus = '{s}' then cast(o_totalprice as decimal(18,2)) end) as decimal(28,2)) as \"{s}\"" for s in "FOP") + """
from orders join customer on o_custkey = c_custkey group by 1""")
def _(t: Tables):
    o = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    return A.pivot_sum(o, ["c_mktsegment"], "o_orderstatus", ["F", "O", "P"], F.sum(money("o_totalprice")))


# ---- sets, order, extremes

@query("order_by_recipe", "select o_orderkey, o_orderpriority, o_totalprice from orders")
def _(t: Tables):
    return S.order_by_recipe(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), ["o_orderpriority", "o_totalprice desc", "o_orderkey asc"])


@query("top_k", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def _(t: Tables):
    return S.top_k(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice desc", "o_orderkey"], 25)


@query("max_value", """
select 'customer' as tab, coalesce(max(c_custkey), 0) as max_value from customer union all select 'supplier', coalesce(max(s_suppkey), 0) from supplier
union all select 'orders after 2100', coalesce(max(o_orderkey), 0) from orders where o_orderdate > timestamp '2100-01-01'""")
def _(t: Tables):
    return S.union_all_rows(
        S.max_value(t.customer, "c_custkey", default=0).select(F.lit("customer").alias("tab"), "*"),
        S.max_value(t.supplier, "s_suppkey", default=0).select(F.lit("supplier").alias("tab"), "*"),
        S.max_value(t.orders.where("o_orderdate > timestamp_ntz '2100-01-01'"), "o_orderkey", default=0).select(F.lit("orders after 2100").alias("tab"), "*"))


_SETS = {"open": "o_orderstatus = 'O' and o_orderpriority = '1-URGENT'", "low": "o_orderpriority = '5-LOW' and o_orderstatus <> 'O'"}


def _two(t: Tables):
    return [t.orders.where(c).select("o_custkey", F.year("o_orderdate").alias("year")) for c in _SETS.values()]


def _two_sql(op: str) -> str:
    a, b = (f"select o_custkey, cast(year(o_orderdate) as int) as year from orders where {c}" for c in _SETS.values())
    return f"({a}) {op} ({b})"


@query("union_all_rows", _two_sql("union all"))
def _(t: Tables):
    return S.union_all_rows(*_two(t))


@query("union_distinct_rows", _two_sql("union"))
def _(t: Tables):
    return S.union_distinct_rows(*_two(t))


@query("union_recipe", _two_sql("union all"))
def _(t: Tables):
    return S.union_recipe(*_two(t))


@query("intersect_recipe", _two_sql("intersect"))
def _(t: Tables):
    return S.intersect_recipe(*_two(t))


@query("difference_recipe", _two_sql("except"))
def _(t: Tables):
    return S.difference_recipe(*_two(t))


@query("union_padded", """
select distinct * from (select l_orderkey as id, 'L' as kind, l_returnflag as flag, cast(null as varchar) as status from lineitem
union all select o_orderkey, 'H', null, o_orderstatus from orders)""")
def _(t: Tables):
    lines = t.lineitem.select(F.col("l_orderkey").alias("id"), F.lit("L").alias("kind"), F.col("l_returnflag").alias("flag"))
    heads = t.orders.select(F.col("o_orderkey").alias("id"), F.lit("H").alias("kind"), F.col("o_orderstatus").alias("status"))
    return S.union_padded(lines, heads, distinct=True)
