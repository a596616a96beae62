"""Report marts: scorecards, footfall, bulk buyers, switching and product performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions import exprs as E
from lakeops.operators import aggs as A
from lakeops.operators import clean as C
from lakeops.operators import joins as J
from lakeops.operators import sets as S
from lakeops.operators import windows as W
from lakeops.plans.cleaning import _half_up
from lakeops.plans.facts import ITEMS_SQL, items
from lakeops.plans.relational import money
from lakeops.registry import Tables, query
from lakeops.session import fresh_path, materialise
from lakeops.sources import files as R
from lakeops.sources import sinks as O

AS_OF = "2001-08-01 00:00:00"
AMOUNT = "cast(l_extendedprice as decimal(18,2))"
QTY = "cast(l_quantity as decimal(18,2))"


# ---- dates and scorecards

@query("mart_exec_dates", """
with w as (select distinct cast(o_orderdate as date) as weekly_date from orders where dayofweek(o_orderdate) = 0), m as (select cast(o_orderdate as date) as d from orders where month(o_orderdate) % 5 <> 0),
a as (select cast(cast(year(d) as varchar) || cast(month(d) as varchar) as int) as ym, max(d) as max_monthly_date from m group by 1),
b as (select cast(cast(year(d + interval 1 month) as varchar) || cast(month(d + interval 1 month) as varchar) as int) as ym, max(d) as previous_month_date from m group by 1),
j as (select weekly_date, max_monthly_date, previous_month_date from w left join (a join b using (ym)) on ym = cast(cast(year(weekly_date) as varchar) || cast(month(weekly_date) as varchar) as int))
select weekly_date, max_monthly_date, coalesce(previous_month_date, last_value(max_monthly_date ignore nulls) over (order by weekly_date rows unbounded preceding)) as previous_month_date from j""")
def mart_exec_dates(t: Tables):
    """Each weekly date with the last day of its month and of the month before; gaps take the last known month."""
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("d"))
    weekly = days.where(F.dayofweek("d") == 1).select(F.col("d").alias("weekly_date")).distinct().withColumn("ym", E.year_month_int(F.col("weekly_date")))
    monthly = days.where(F.month("d") % 5 != 0)
    a = monthly.groupBy(E.year_month_int(F.col("d")).alias("ym")).agg(F.max("d").alias("max_monthly_date"))
    b = monthly.groupBy(E.year_month_int(F.add_months("d", 1)).alias("ym")).agg(F.max("d").alias("previous_month_date"))
    j = weekly.join(a.join(b, "ym"), "ym", "left").withColumn("_last", F.col("max_monthly_date"))
    filled = W.fill_forward_global(j, "_last", order=["weekly_date"])
    return filled.select("weekly_date", "max_monthly_date", F.coalesce("previous_month_date", "_last").alias("previous_month_date"))


@query("mart_scorecards", """
select 'monthly' as card, cast(date_trunc('month', o_orderdate) as timestamp) as date, o_orderpriority as kpi, case when count(*) % 5 = 0 then null else cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(24,4)) end as actual from orders group by 2, 3
union all select 'weekly', cast(date_trunc('week', o_orderdate) as timestamp), o_orderpriority, case when count(*) % 5 = 0 then null else cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(24,4)) end from orders group by 2, 3""")
def mart_scorecards(t: Tables):
    """Monthly and weekly KPI files: d/M/yyyy dates and amounts as text, where a bad amount becomes null."""
    cards = []
    for card, unit in (("monthly", "month"), ("weekly", "week")):
        path = fresh_path(t.spark, card)
        kpi = t.orders.groupBy(F.date_trunc(unit, "o_orderdate").alias("day"), "o_orderpriority").agg(F.sum(money("o_totalprice")).alias("v"), F.count(F.lit(1)).alias("n"))
        text = F.when(F.col("n") % 5 == 0, "n/a").otherwise(F.col("v").cast("string"))
        kpi.select(F.date_format("day", "d/M/yyyy").alias("Date"), F.col("o_orderpriority").alias("KPI"), text.alias("Actual")).write.csv(path, header=True)
        raw = R.scan_csv_header_glob(t.spark, f"{path}/*.csv")
        typed = raw.select(F.lit(card).alias("card"), F.to_date("Date", "d/M/yyyy").cast("timestamp_ntz").alias("date"), F.col("KPI").alias("kpi"), F.col("Actual").try_cast("decimal(24,4)").alias("actual"))
        cards.append(O.truncate_and_load(typed, fresh_path(t.spark, f"scorecard_{card}")))
    return S.union_all_rows(*cards)


KPI_STYLES = {"view": ("millions", "percent_change"), "click": ("pounds", "percent_change"), "purchase": ("pounds", "pounds_change"), "signup": ("percent", "points_change"), "error": ("percent", "percent_change")}


@query("mart_kpi_text", f"""
with k as (select cast(ts as date) as day, event_type, cast(sum(cast(value as decimal(18,2))) * 1000 as decimal(18,4)) as cy, cast(sum(case when event_id % 2 = 0 then cast(value as decimal(18,2)) else 0 end) as decimal(18,4)) as ly from events group by 1, 2),
v as (select *, cast((cy * cast(0.001 as decimal(4,3)) - 2 * ly) * cast(0.001 as decimal(4,3)) as decimal(18,4)) as yoy from k),
x as (select *, cast({_half_up('abs(yoy) * 100', 1)} as varchar) as pct, cast({_half_up('abs(yoy)', 2)} as varchar) as pnd, cast({_half_up('cy * cast(0.000001 as decimal(7,6))', 2)} as varchar) || 'm' as cym, cast({_half_up('ly * cast(0.000001 as decimal(7,6))', 2)} as varchar) || 'm' as lym,
 '£' || cast(cast(round(cy, 2) as decimal(18,2)) as varchar) as cyp, '£' || cast(cast(round(ly, 2) as decimal(18,2)) as varchar) as lyp, cast({_half_up('cy * 100', 0)} as varchar) || '%' as cyc, cast({_half_up('ly * 100', 0)} as varchar) || '%' as lyc from v)
select day, event_type, case event_type when 'view' then cym when 'click' then cyp when 'purchase' then cyp else cyc end as value_cy, case event_type when 'view' then lym when 'click' then lyp when 'purchase' then lyp else lyc end as value_ly,
 case when event_type = 'purchase' then case when yoy >= 0 then '£' || pnd else '(£' || pnd || ')' end when event_type = 'signup' then case when yoy >= 0 then pct || '%p' else '(' || pct || '%p)' end
  else case when yoy >= 0 then pct || '%' else '(' || pct || '%)' end end as yoy from x""")
def mart_kpi_text(t: Tables):
    """KPI values as report text, each kind of KPI in its own style; one pass in place of a union per style."""
    v = money("value")
    k = t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        (F.sum(v) * 1000).cast("decimal(18,4)").alias("cy"), F.sum(F.when(F.col("event_id") % 2 == 0, v).otherwise(0)).cast("decimal(18,4)").alias("ly"))
    mille = F.lit("0.001").cast("decimal(4,3)")
    k = k.withColumn("yoy", ((F.col("cy") * mille - F.col("ly") * 2) * mille).cast("decimal(18,4)"))
    pick = lambda c, i: C.case_rules([(F.col("event_type") == e, E.format_kpi(F.col(c), s[i])) for e, s in KPI_STYLES.items()])
    return k.select("day", "event_type", pick("cy", 0).alias("value_cy"), pick("ly", 0).alias("value_ly"), pick("yoy", 1).alias("yoy")).distinct()


@query("mart_footfall", """
with f as (select cast(ts as date) as day, cast(hour(ts) as int) as hour, c_nationkey, count(*) as footfall from events join customer on c_custkey = user_id where event_type in ('view', 'click') group by 1, 2, 3),
b as (select cast(ts as date) as day, cast(hour(ts) as int) as hour, c_nationkey, count(distinct user_id) as baskets, cast(sum(cast(value as decimal(18,2))) as decimal(28,2)) as sales from events join customer on c_custkey = user_id where event_type = 'purchase' group by 1, 2, 3)
select f.day, f.hour, f.c_nationkey as store, cast(isoyear(f.day) * 100 + week(f.day) as int) as year_week, left(dayname(f.day), 3) as day_name, footfall, baskets, sales from f join b using (day, hour, c_nationkey) where f.day >= date '2024-01-08'""")
def mart_footfall(t: Tables):
    """Visits and baskets per store and hour; recent weeks are replaced, and the trailing window is returned."""
    home = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("store"))
    e = t.events.where("event_type in ('view', 'click', 'purchase')").join(home, "user_id").withColumns({"day": F.to_date("ts"), "hour": F.hour("ts")})
    # Visits and baskets in one pass: per visitor first, then per hour.
    per = e.groupBy("store", "day", "hour", "user_id").agg(F.sum(F.expr("if(event_type = 'purchase', 0, 1)")).alias("v"), F.max(F.expr("if(event_type = 'purchase', 1, 0)")).alias("b"),
                                                           F.sum(F.when(F.col("event_type") == "purchase", money("value"))).alias("s"))
    hourly = per.groupBy("store", "day", "hour").agg(F.sum("v").alias("footfall"), F.sum("b").cast("bigint").alias("baskets"), F.sum("s").cast("decimal(28,2)").alias("sales")).where("footfall > 0 and baskets > 0")
    iso_year = F.extract(F.lit("YEAROFWEEK"), "day")
    out = hourly.select("store", "day", "hour", F.date_format("day", "E").alias("day_name"), "footfall", "baskets", "sales", E.year_week_key(iso_year, F.weekofyear("day")).alias("year_week"))
    dest = fresh_path(t.spark, "footfall")
    O.write_partitioned_append(out.where("day < date '2024-01-25'").withColumn("footfall", F.col("footfall")), dest, keys=["year_week"])
    kept = O.replace_recent_partitions(out.where("year_week >= 202404"), dest, key="year_week", cutoff=202404)
    return kept.where("day >= date '2024-01-08'")


BULK_UNITS, BULK_VISITS = 60, 5


@query("mart_bulk_buyers", f"""
with {ITEMS_SQL}, f as (select o_custkey, day, year(day) * 100 + month(day) as period, o_orderkey, o_orderpriority, n_nationkey, l_suppkey, p_partkey, p_brand, {QTY} as units, {AMOUNT} as spend,
  case when (p_name like '%ring%' or p_name like '%gear%') and p_name not like '%old%' then 'ROUND' when p_name like '%bolt%' or p_partkey in (7, 11, 13) then 'FASTENER' when p_name like '%widget%' or p_name like '%gizmo%' then 'DEVICE' else 'OTHER' end as ladder
  from items join part on p_partkey = l_partkey where l_suppkey not between 17 and 19 and l_suppkey not between 30 and 39),
m as (select o_custkey from f where ladder = 'FASTENER' group by o_custkey, period having sum(units) >= {BULK_UNITS} union select o_custkey from (select distinct o_custkey, day, o_orderkey, l_suppkey from f) group by o_custkey, day having count(*) >= {BULK_VISITS}),
s as (select o_custkey, o_orderkey, case when o_orderpriority = '1-URGENT' then 'Online' else 'Stores' end as channel, n_nationkey, p_partkey, p_brand, ladder, sum(units) as units, sum(spend) as spend from f group by 1, 2, 3, 4, 5, 6, 7 having sum(units) > 0 and sum(spend) >= 0)
select o_custkey, o_orderkey, channel, p_partkey, ladder, p_brand, case when m.o_custkey is null then 'Domestic' else 'Bulk' end as status, case when n_nationkey < 5 then 'UK' else cast(n_nationkey as varchar) end as country,
 cast(units as decimal(28,2)) as units, cast(spend as decimal(28,2)) as spend, timestamp '{AS_OF}' as create_datetime, cast(null as timestamp) as update_datetime from s left join m using (o_custkey)""")
def mart_bulk_buyers(t: Tables):
    """Every buyer's purchases, tagged by whether the buyer ever bought in bulk.

    Bulk means many units of one product class in a month, or many visits in
    a day. The classified lines are stored once and read by all three steps.
    """
    from lakeops.plans.cleaning import PART_RULES
    parts = C.keyword_classify(t.part.select("p_partkey", "p_name", "p_brand"), "p_name", PART_RULES, default="OTHER", name="ladder")
    rows = items(t, [F.col("l_partkey").alias("p_partkey"), "l_suppkey", money("l_quantity").alias("units"), money("l_extendedprice").alias("spend")], "o_orderpriority")
    rows = C.range_exclusions(rows, "l_suppkey", [(17, 19), (30, 39)]).join(parts, "p_partkey")
    f = materialise(rows.select("o_custkey", "day", "o_orderkey", "o_orderpriority", "n_nationkey", "l_suppkey", "p_partkey", "p_brand", "ladder", "units", "spend"), name="bulk")
    period = f.where("ladder = 'FASTENER'").withColumn("period", F.date_format("day", "yyyyMM").cast("int"))
    monthly = A.agg_having(period, ["o_custkey", "period"], [F.sum("units").alias("u")], f"u >= {BULK_UNITS}").select("o_custkey").distinct()
    visits = A.distinct_rows(f, ["o_custkey", "day", "o_orderkey", "l_suppkey"])
    daily = A.agg_having(visits, ["o_custkey", "day"], [F.count(F.lit(1)).alias("n")], f"n >= {BULK_VISITS}").select("o_custkey").distinct()
    bulk = J.join_full_coalesce_keys(monthly.withColumn("by_month", F.lit(True)), daily.withColumn("by_day", F.lit(True)), ["o_custkey"]).select("o_custkey", F.lit("Bulk").alias("status"))
    channel = F.when(F.col("o_orderpriority") == "1-URGENT", "Online").otherwise("Stores").alias("channel")
    sums = A.agg_having(f.select("*", channel), ["o_custkey", "o_orderkey", "channel", "n_nationkey", "p_partkey", "p_brand", "ladder"],
                        [F.sum("units").cast("decimal(28,2)").alias("units"), F.sum("spend").cast("decimal(28,2)").alias("spend")], "units > 0 and spend >= 0")
    out = C.default_sentinels(sums.join(bulk, "o_custkey", "left"), {"status": "Domestic"})
    out = out.withColumn("country", F.when(F.col("n_nationkey") < 5, "UK").otherwise(F.col("n_nationkey").cast("string"))).drop("n_nationkey")
    return C.audit_columns(out.distinct(), as_of=AS_OF)


@query("mart_switching", f"""
with {ITEMS_SQL}, x as (select case when l_returnflag = 'R' then 'IE' else 'UK' end as country, year(l_shipdate) as run, p_type as grp, p_brand as brand1, 'Brand#' || cast(l_suppkey % 25 + 1 as varchar) as brand2, p_partkey from items join part on p_partkey = l_partkey),
newest as (select country, max(run) as run from x where run not in (2001) group by 1), y as (select x.* from x semi join newest on x.country = newest.country and x.run = newest.run),
c as (select country, cast(run as int) as run, grp, brand1, brand2, cast(count(*) as decimal(30,3)) as cann_percent, count(distinct p_partkey) as product_count from y group by all),
k as (select *, grp || country as group_key, case when brand1 = brand2 then cann_percent else 0 end as rbp from c)
select cast(dense_rank() over (order by group_key, country) as bigint) as group_sk, run, country, brand1, brand2, cann_percent, cast(rbp as decimal(30,3)) as rbp, cast(max(rbp) over (partition by brand1, run, grp, country) as decimal(30,3)) as proportion_of_rbp, product_count from k""")
def mart_switching(t: Tables):
    """Switching shares between brands of the newest run per country, with a brand's own share on all its rows."""
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("grp"), F.col("p_brand").alias("brand1"))
    li = t.lineitem.select("l_partkey", "l_returnflag", F.year("l_shipdate").alias("run"), F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 25 + 1).cast("string")).alias("brand2"))
    rows = li.join(parts, "l_partkey").withColumn("country", F.when(F.col("l_returnflag") == "R", "IE").otherwise("UK"))
    latest = J.join_latest_snapshot(rows, rows.where("run <> 2001").select("country", "run"), key=["country"], by="run", few_keys=True)
    keys = ["country", "run", "grp", "brand1", "brand2"]
    shares = A.agg_two_level(latest, keys, ["l_partkey"], inner_aggs=[F.count(F.lit(1)).alias("n")],
                             outer_aggs=[F.sum("n").cast("decimal(30,3)").alias("cann_percent"), F.count(F.lit(1)).alias("product_count")])
    own = F.when(F.col("brand1") == F.col("brand2"), F.col("cann_percent")).otherwise(F.lit(0).cast("decimal(30,3)"))
    shares = materialise(shares.withColumns({"rbp": own, "group_key": F.concat("grp", "country")}), name="shares")
    out = W.window_max_within(shares, partition=["brand1", "run", "grp", "country"], measure="rbp", name="proportion_of_rbp")
    out = W.dense_surrogate(out, ["group_key", "country"], name="group_sk")
    return out.select("group_sk", "run", "country", "brand1", "brand2", "cann_percent", "rbp", "proportion_of_rbp", "product_count")


# ---- product performance

PERIODS = [("Previous 4 Weeks", 1, 4), ("Previous 12 Weeks", 1, 12), ("Previous 52 Weeks", 1, 52), ("Prior Year", 13, 64), ("Baseline Year", 157, 208)]
PERIODS_SQL = "(values " + ", ".join(f"('{l}', {a}, {b})" for l, a, b in PERIODS) + ") p(time_period, lo, hi)"
SALES_SQL = f"""weekly as (select cast(date_trunc('week', l_shipdate) as date) as week, l_partkey, case when l_linestatus = 'O' then 'Stores' else 'Online' end as location, cast(sum({AMOUNT}) as decimal(28,2)) as tesp, cast(sum({QTY}) as decimal(28,2)) as units, count(distinct l_suppkey) as places from lineitem group by 1, 2, 3),
sales as (select week, l_partkey, location, cast(sum(tesp_ty) as decimal(28,2)) as tesp_ty, cast(sum(tesp_ly) as decimal(28,2)) as tesp_ly, cast(sum(units_ty) as decimal(28,2)) as units_ty, cast(sum(units_ly) as decimal(28,2)) as units_ly, cast(max(places) as bigint) as places from
  (select week, l_partkey, location, tesp as tesp_ty, 0 as tesp_ly, units as units_ty, 0 as units_ly, places from weekly union all select week + 364, l_partkey, location, 0, tesp, 0, units, 0 from weekly where week + 364 <= (select max(week) from weekly)) group by 1, 2, 3),
ranked as (select *, dense_rank() over (order by week desc) as week_rank from sales)"""


def sales(t: Tables) -> DataFrame:
    """Sales per week, product and location, this year beside the same week last year, with a week rank."""
    li = t.lineitem.select(F.date_trunc("week", "l_shipdate").cast("date").alias("week"), "l_partkey", F.when(F.col("l_linestatus") == "O", "Stores").otherwise("Online").alias("location"),
                           "l_suppkey", money("l_extendedprice").alias("tesp"), money("l_quantity").alias("units"))
    keys = ["week", "l_partkey", "location"]
    weekly = A.agg_two_level(li, keys, ["l_suppkey"], inner_aggs=[F.sum("tesp").alias("tesp"), F.sum("units").alias("units")],
                             outer_aggs=[F.sum("tesp").cast("decimal(28,2)").alias("tesp"), F.sum("units").cast("decimal(28,2)").alias("units"), F.count(F.lit(1)).alias("places")])
    last = t.lineitem.agg(F.date_trunc("week", F.max("l_shipdate")).cast("date").alias("w")).scalar()
    # Each weekly row counts for its own week and for the one 52 weeks later: no self join.
    turns = F.explode(F.array(F.lit(0), F.lit(364))).alias("ahead")
    zero = F.lit(0).cast("decimal(28,2)")
    now = F.col("ahead") == 0
    both = weekly.select("*", turns).select(
        F.date_add("week", F.col("ahead")).alias("week"), "l_partkey", "location", F.when(now, F.col("tesp")).otherwise(zero).alias("tesp_ty"), F.when(now, zero).otherwise(F.col("tesp")).alias("tesp_ly"),
        F.when(now, F.col("units")).otherwise(zero).alias("units_ty"), F.when(now, zero).otherwise(F.col("units")).alias("units_ly"), F.when(now, F.col("places")).otherwise(F.lit(0)).alias("places"))
    both = both.where(F.col("week") <= last)
    summed = both.groupBy(*keys).agg(*[F.sum(c).cast("decimal(28,2)").alias(c) for c in ("tesp_ty", "tesp_ly", "units_ty", "units_ly")], F.max("places").alias("places"))
    return W.week_rank_desc(materialise(summed, name="sales"), week="week", name="week_rank")


@query("mart_performance_store", f"""
with {SALES_SQL} select time_period, p_brand, location, cast(sum(units_ty) as decimal(28,2)) as units_ty, cast(sum(units_ly) as decimal(28,2)) as units_ly, cast(sum(units_ty) - sum(units_ly) as decimal(28,2)) as units_change,
 cast(sum(tesp_ty) as decimal(28,2)) as tesp_ty, cast(sum(tesp_ly) as decimal(28,2)) as tesp_ly, cast(sum(tesp_ty) - sum(tesp_ly) as decimal(28,2)) as tesp_change
from ranked join {PERIODS_SQL} on week_rank between lo and hi join part on p_partkey = l_partkey group by 1, 2, 3""")
def mart_performance_store(t: Tables):
    """Units and sales per period, brand and location against last year."""
    rows = sales(t).join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    out = A.agg_rolling_periods(rows, PERIODS, rank="week_rank", keys=["p_brand", "location"], aggs={c: F.col(c) for c in ("units_ty", "units_ly", "tesp_ty", "tesp_ly")})
    out = out.withColumns({"units_change": F.col("units_ty") - F.col("units_ly"), "tesp_change": F.col("tesp_ty") - F.col("tesp_ly")})
    return out.withColumns({c: F.col(c).cast("decimal(28,2)") for c in out.columns if c.startswith(("units", "tesp"))})


@query("mart_performance_pareto", f"""
with {SALES_SQL}, s as (select p_type, location, l_partkey, cast(sum(tesp_ty) as decimal(28,2)) as tesp_ty, cast(sum(tesp_ty) as double) / count(distinct week) * 52 as annualised from sales join part on p_partkey = l_partkey where tesp_ty > 0 group by 1, 2, 3),
r as (select *, dense_rank() over (partition by p_type, location order by annualised desc) as place from s)
select p_type, location, l_partkey, tesp_ty, annualised, place / cast(max(place) over (partition by p_type, location) as double) as rank_percent,
 cast(sum(tesp_ty) over (partition by p_type, location order by tesp_ty desc, l_partkey rows unbounded preceding) as double) / cast(sum(tesp_ty) over (partition by p_type, location) as double) as cumulative_share from r""")
def mart_performance_pareto(t: Tables):
    """Annualised sales per product, its rank in its class, and the Pareto curve."""
    rows = sales(t).where("tesp_ty > 0").join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    keys = ["p_type", "location", "l_partkey"]
    per = rows.groupBy(*keys).agg(F.sum("tesp_ty").cast("decimal(28,2)").alias("tesp_ty"), (F.sum("tesp_ty").cast("double") / F.count_distinct("week") * 52).alias("annualised"))
    per = materialise(per, name="pareto")
    part = ["p_type", "location"]
    placed = W.rank_percent(per, partition=part, entity=["l_partkey"], measure="annualised").select(*keys, "rank_percent")
    curve = W.cumulative_share(per, partition=part, measure="tesp_ty", tie_break=["l_partkey"])
    return curve.join(placed, keys)


@query("mart_performance_bands", f"""
with {SALES_SQL}, p as (select time_period, location, l_partkey, cast(sum(tesp_ty) as decimal(28,2)) as tesp, cast(min(p_retailprice) as decimal(18,2)) as idx from ranked join {PERIODS_SQL} on week_rank between lo and hi join part on p_partkey = l_partkey group by 1, 2, 3)
select time_period, location, {", ".join(f"count(distinct case when {c} then l_partkey end) as band_{i}_count, cast(coalesce(sum(case when {c} then tesp end), 0) as decimal(28,2)) as band_{i}_value" for i, c in enumerate(("idx < 950", "idx between 950 and 1200", "idx between 1200 and 1700", "idx > 1700"), 1))} from p group by 1, 2""")
def mart_performance_bands(t: Tables):
    """Products and sales per price-index band, closed bands, per period."""
    out = A.agg_rolling_periods(sales(t), PERIODS, rank="week_rank", keys=["location", "l_partkey"], aggs={"tesp": F.col("tesp_ty")})
    out = out.join(t.part.select(F.col("p_partkey").alias("l_partkey"), money("p_retailprice").alias("idx")), "l_partkey")
    b = A.agg_bands(out, ["time_period", "location"], "idx", [950, 1200, 1700], entity="l_partkey", measure=F.col("tesp"), closed=True)
    return b.withColumns({f"band_{i}_value": F.col(f"band_{i}_value").cast("decimal(28,2)") for i in range(1, 5)})


def _main(t: Tables) -> DataFrame:
    """Product rows per period with their type: new, deleted or base."""
    out = A.agg_rolling_periods(sales(t), PERIODS, rank="week_rank", keys=["location", "l_partkey"], aggs={c: F.col(c) for c in ("tesp_ty", "tesp_ly", "units_ty", "units_ly")})
    gone = t.part.where("p_size = 7").select(F.col("p_partkey").alias("l_partkey"), F.lit("Y").alias("gone"))
    out = out.join(gone, "l_partkey", "left").join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type"), "l_partkey")
    kind = C.case_rules([("tesp_ty > 0 and tesp_ly = 0", "NPD"), ("gone is not null", "Deletes")], "Base")
    return out.withColumns({"kind": kind, "discontinued": F.coalesce("gone", F.lit("N"))}).drop("gone")


MAIN_SQL = f"""{SALES_SQL}, main as (select time_period, location, l_partkey, cast(sum(tesp_ty) as decimal(28,2)) as tesp_ty, cast(sum(tesp_ly) as decimal(28,2)) as tesp_ly, cast(sum(units_ty) as decimal(28,2)) as units_ty, cast(sum(units_ly) as decimal(28,2)) as units_ly from ranked join {PERIODS_SQL} on week_rank between lo and hi group by 1, 2, 3),
typed as (select main.*, p_brand, p_type, case when tesp_ty > 0 and tesp_ly = 0 then 'NPD' when p_size = 7 then 'Deletes' else 'Base' end as kind, case when p_size = 7 then 'Y' else 'N' end as discontinued from main join part on p_partkey = l_partkey)"""


@query("mart_performance_bridge", f"""
with {MAIN_SQL} select time_period, location, kind, cast(sum(tesp_ty) - sum(tesp_ly) as decimal(28,2)) as amount from typed group by 1, 2, 3 union all select time_period, location, 'LY', cast(sum(tesp_ly) as decimal(28,2)) from typed group by 1, 2""")
def mart_performance_bridge(t: Tables):
    """From last year's sales to this year's, by product type, per period and location; the baseline year is stored once."""
    out = A.agg_bridge(_main(t), ["time_period", "location"], F.col("tesp_ty"), F.col("tesp_ly"), kind="kind")
    out = materialise(out.withColumn("amount", F.col("amount").cast("decimal(28,2)")), name="bridge")
    stored = O.truncate_and_load(out.where("time_period = 'Baseline Year'"), fresh_path(t.spark, "bridge_baseline"))
    return S.frozen_baseline_union(out, stored, period_col="time_period", period="Baseline Year")


@query("mart_performance", f"""
with {MAIN_SQL}, fund as (select location, l_partkey, cast(sum(tesp) as decimal(28,2)) as funding from weekly where week >= (select max(week) from weekly) - 700 group by 1, 2),
bt as (select time_period, location, p_brand, dense_rank() over (partition by time_period, location order by sum(tesp_ty) desc) as place from typed group by 1, 2, 3)
select time_period, location, l_partkey, p_brand, case when place <= 10 then p_brand else 'Others' end as brand_with_others, p_type, kind, discontinued, tesp_ty, tesp_ly, units_ty, units_ly, coalesce(case when kind <> 'Deletes' then funding end, cast(0 as decimal(28,2))) as funding,
 cast(tesp_ty as double) / nullif(cast(sum(tesp_ty) over (partition by time_period, location, p_brand) as double), 0) as share_of_brand
from typed join bt using (time_period, location, p_brand) left join fund using (location, l_partkey)""")
def mart_performance(t: Tables):
    """Product performance per period: type, top brands, funding of its own channel, and share of its brand."""
    main = materialise(_main(t), name="performance")
    recent = t.lineitem.agg(F.date_sub(F.date_trunc("week", F.max("l_shipdate")).cast("date"), 700).alias("d")).scalar()
    # The bound is the start of a week, so the day itself can be compared with it, and the scan can skip files.
    li = t.lineitem.where(F.col("l_shipdate") >= recent.cast(t.lineitem.schema["l_shipdate"].dataType))
    funded = materialise(li.groupBy("l_linestatus", "l_partkey").agg(F.sum(money("l_extendedprice")).cast("decimal(28,2)").alias("funding")), name="funding")
    fund = lambda s: funded.where(f"l_linestatus = '{s}'").drop("l_linestatus")
    out = W.top_n_others(main, partition=["time_period", "location"], name="p_brand", measure="tesp_ty", n=10, label="brand_with_others")
    out = J.join_branch_by_value(out, {"Stores": fund("O"), "Online": fund("F")}, on=["l_partkey"], channel="location")
    out = out.withColumn("funding", F.coalesce(F.when(F.col("kind") != "Deletes", F.col("funding")), F.lit(0).cast("decimal(28,2)")))
    out = W.window_total(out, partition=["time_period", "location", "p_brand"], measure="tesp_ty", name="_brand")
    share = F.col("tesp_ty").cast("double") / F.nullif(F.col("_brand").cast("double"), F.lit(0.0))
    out = out.withColumn("share_of_brand", share).drop("_brand")
    return out.withColumns({c: F.col(c).cast("decimal(28,2)") for c in ("tesp_ty", "tesp_ly", "units_ty", "units_ly")})
