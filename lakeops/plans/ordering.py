"""Window results and the calendar over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import sets as S
from lakeops.operators import windows as W
from lakeops.plans.relational import money
from lakeops.registry import Tables, query
from lakeops.sources import calendar as K

AS_OF = "2001-08-01 00:00:00"

# ---- calendar

DOW = "cast(dayofweek({}) as int)"  # 0 is Sunday


def _fin_start(y: str) -> str:
    return f"(make_date({y}, 9, 1) + ((7 - {DOW.format(f'make_date({y}, 9, 1)')}) % 7)::int)"


CAL_SQL = f"""cal0 as (select cast(unnest(generate_series(d1, d2, interval 1 day)) as date) as d from
  (select cast(min(o_orderdate) as date) as d1, cast(max(o_orderdate) as date) as d2 from orders)),
cal1 as (select d, cast(year(d) as int) as y, d - {DOW.format('d')} as week_commencing_date, {_fin_start('cast(year(d) as int)')} as fs,
  {_fin_start('cast(year(d) as int) + 1')} as fs_next, {_fin_start('cast(year(d) as int) - 1')} as fs_prev from cal0),
cal2 as (select *, case when fs <= d then fs else fs_prev end as start_fin_year, case when fs <= d then fs_next - 1 else fs - 1 end as end_fin_year,
  case when fs <= d then y + 1 else y end as fy from cal1),
cal3 as (select *, cast(end_fin_year - start_fin_year + 1 as int) as days_in_fin_year, cast((d - start_fin_year) // 7 + 1 as int) as financial_week_number from cal2),
cal4 as (select *, least((financial_week_number - 1) // 13 + 1, 4) as q from cal3),
calendar as (select d as date_value, cast(strftime(d, '%Y%m%d') as int) as date_key, week_commencing_date, financial_week_number, cast(fy as varchar) as financial_year,
  start_fin_year, end_fin_year, days_in_fin_year, cast(q as int) as financial_quarter_number,
  cast((q - 1) * 3 + case when financial_week_number - (q - 1) * 13 <= 4 then 1 when financial_week_number - (q - 1) * 13 <= 8 then 2 else 3 end as int) as financial_month_number,
  cast(date_trunc('month', d) as date) as month_start_date, last_day(d) as month_end_date, y from cal4)"""


def calendar(t: Tables, column: str = "o_orderdate"):
    """The calendar over the days the orders span."""
    bounds = t.orders.agg(F.min(column).cast("date").alias("first_day"), F.max(column).cast("date").alias("last_day"))
    return K.calendar_dimension(bounds, as_of=AS_OF)


@query("calendar_dimension", f"""
with {CAL_SQL}
select date_key, cast(julian(date_value) as int) as julian_day, cast(date_value as timestamp) as date_time_start, cast(date_value as timestamp) + interval '23 hours 59 minutes 59 seconds' as date_time_end,
 date_value, cast(dayofweek(date_value) + 1 as int) as day_of_week_number, dayname(date_value) as day_of_week_desc, left(dayname(date_value), 3) as day_of_week_sdesc,
 cast(case when dayofweek(date_value) in (0, 6) then 1 else 0 end as int) as weekend_flag, cast(day(date_value) as int) as day_of_month_number,
 strftime(date_value, '%m') as month_value, monthname(date_value) as month_desc, left(monthname(date_value), 3) as month_sdesc, month_start_date, month_end_date,
 cast(day(month_end_date) as int) as days_in_month, cast(case when date_value = month_end_date then 1 else 0 end as int) as last_day_of_month_flag,
 cast(dayofyear(date_value) as int) as day_of_year_number, strftime(date_value, '%Y') as year_value, 'Year ' || strftime(date_value, '%Y') as year_desc, strftime(date_value, '%y') as year_sdesc,
 make_date(y, 1, 1) as year_start_date, make_date(y, 12, 31) as year_end_date, cast(case when date_value = make_date(y, 12, 31) then 1 else 0 end as int) as last_day_of_year_flag,
 cast(dayofyear(make_date(y, 12, 31)) as int) as days_in_year, start_fin_year, end_fin_year, cast(days_in_fin_year // 7 as int) as weeks_in_fin_year, financial_week_number, days_in_fin_year,
 financial_year, financial_month_number, financial_quarter_number, week_commencing_date, cast(week(week_commencing_date) as int) as calendar_week,
 timestamp '{AS_OF}' as create_datetime, cast(null as timestamp) as update_datetime from calendar""")
def _(t: Tables):
    return calendar(t)


@query("week_anchor_calendar", f"""
with {CAL_SQL}, w as (select date_key, date_value, date_value - ((cast(dayofweek(date_value) as int) + 6) % 7) as week_anchor,
 case when week(date_value) = 1 and month(date_value) = 12 then 53 else week(date_value) end - case when y in (1999, 2000) then 1 else 0 end as n from calendar)
select date_key, date_value, week_anchor, cast(n as int) as week_number from w""")
def _(t: Tables):
    return K.week_anchor_calendar(calendar(t), minus_one_years=(1999, 2000))


_MID, _EDGE = "2000-06-14", "2000-09-05"  # the second falls in financial week 1


@query("previous_fin_week", f"""
with {CAL_SQL}, d as (select * from (values (date '{_MID}'), (date '{_EDGE}')) v(as_of))
select as_of, case when a.financial_week_number = 1 then b.financial_week_number else a.financial_week_number - 1 end as fin_week,
 case when a.financial_week_number = 1 then b.financial_year else a.financial_year end as fin_year
from d join calendar a on a.date_value = as_of join calendar b on b.date_value = as_of - 7""")
def _(t: Tables):
    cal = calendar(t)
    return S.union_all_rows(*[K.previous_fin_week(cal, as_of=d).select(F.lit(d).cast("date").alias("as_of"), "*") for d in (_MID, _EDGE)])


@query("previous_month", "select distinct date '2000-05-01' as month_start, date '2000-05-31' as month_end, cast(200005 as int) as month_key from orders")
def _(t: Tables):
    return K.previous_month(calendar(t), as_of=_MID)


@query("week_date_range", f"""
with {CAL_SQL}, p as (select c.financial_week_number - 1 as pw, c.financial_year as py from calendar c where date_value = date '{_MID}')
select 'plain' as variant, cast(min(date_value) as timestamp) as week_start, cast(max(date_value) as timestamp) as week_end from calendar, p where financial_week_number = pw and financial_year = py
union all select 'shifted', cast(min(date_value) + 1 as timestamp), cast(max(date_value) + 1 as timestamp) from calendar, p where financial_week_number = pw and financial_year = py
union all select 'end time', cast(min(date_value) as timestamp), cast(max(date_value) as timestamp) + interval '23 hours 59 minutes 59 seconds' from calendar, p where financial_week_number = pw and financial_year = py""")
def _(t: Tables):
    cal = calendar(t)
    week = K.previous_fin_week(cal, as_of=_MID)
    variants = {"plain": {}, "shifted": {"shift_days": 1}, "end time": {"end_time": True}}
    return S.union_all_rows(*[K.week_date_range(cal, week, **k).select(
        F.lit(n).alias("variant"), F.col("week_start").cast("timestamp_ntz"), F.col("week_end").cast("timestamp_ntz")) for n, k in variants.items()])


@query("load_mode_filter", f"""
with {CAL_SQL}, p as (select c.financial_week_number - 1 as pw, c.financial_year as py from calendar c where date_value = date '{_MID}'),
r as (select min(date_value) + 1 as a, max(date_value) + 1 as b from calendar, p where financial_week_number = pw and financial_year = py)
select 'I' as mode, o_orderkey from orders, r where cast(o_orderdate as date) between a and b
union all select 'H', o_orderkey from orders where cast(o_orderdate as date) between date '1999-01-05' and date '1999-02-10'
union all select 'month', o_orderkey from orders where cast(o_orderdate as date) between date '2000-05-01' and date '2000-05-31'""")
def _(t: Tables):
    cal = calendar(t)
    modes = {
        "I": K.load_mode_filter("o_orderdate", mode="I", cal=cal, as_of=_MID, shift_days=1),
        "H": K.load_mode_filter("o_orderdate", mode="H", date_from="1999-01-05", date_to="1999-02-10"),
        "month": K.load_mode_filter("o_orderdate", mode="I", cal=cal, as_of=_MID, period="month")}
    return S.union_all_rows(*[t.orders.where(c).select(F.lit(m).alias("mode"), "o_orderkey") for m, c in modes.items()])


# ---- windows

TP = "cast(o_totalprice as decimal(18,2))"


@query("window_apply", f"""
select o_orderkey, row_number() over w as place, rank() over (partition by o_orderstatus order by o_orderdate) as day_rank, dense_rank() over (partition by o_orderstatus order by o_orderdate) as day_dense,
 cast(sum({TP}) over (w rows unbounded preceding) as decimal(28,2)) as run, max({TP}) over (w rows unbounded preceding) as best, cast(sum({TP}) over (partition by o_orderstatus) as decimal(28,2)) as total
from orders window w as (partition by o_orderstatus order by o_orderdate, o_orderkey)""")
def _(t: Tables):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate", money("o_totalprice").alias("tp"))
    p, by = ["o_orderstatus"], ["o_orderdate", "o_orderkey"]
    o = W.window_apply(o, partition=p, order=by, func="row_number", name="place")
    o = W.window_apply(o, partition=p, order=["o_orderdate"], func="rank", name="day_rank")
    o = W.window_apply(o, partition=p, order=["o_orderdate"], func="dense_rank", name="day_dense")
    o = W.window_apply(o, partition=p, order=by, func="sum", value="tp", name="run")
    o = W.window_apply(o, partition=p, order=by, func="max", value="tp", name="best")
    o = W.window_apply(o, partition=p, order=[], func="sum", value="tp", name="total")
    return o.select("o_orderkey", "place", "day_rank", "day_dense", "run", "best", "total")


@query("surrogate_key", "select c_name, (select max(s_suppkey) from supplier) + row_number() over (order by c_name) as sk from customer")
def _(t: Tables):
    start = S.max_value(t.supplier, "s_suppkey", default=0).scalar()
    return W.surrogate_key(t.customer.select("c_name"), order=["c_name"], start=start, name="sk")


@query("dense_surrogate", "select o_orderkey, dense_rank() over (order by o_orderpriority, o_orderstatus, cast(o_orderdate as date)) as sk from orders")
def _(t: Tables):
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day"))
    return W.dense_surrogate(o, ["o_orderpriority", "o_orderstatus", "day"], name="sk").select("o_orderkey", "sk")


@query("week_rank_desc", "select event_id, cast(dense_rank() over (order by date_trunc('week', ts) desc) as int) as week_rank from events")
def _(t: Tables):
    e = t.events.select("event_id", F.date_trunc("week", "ts").alias("week"))
    return W.week_rank_desc(e, week="week", name="week_rank").select("event_id", "week_rank")


@query("rank_percent", f"""
with s as (select c_mktsegment, o_custkey, cast(sum({TP}) as decimal(28,2)) as total from orders join customer on o_custkey = c_custkey group by 1, 2),
r as (select *, dense_rank() over (partition by c_mktsegment order by total desc) as place from s)
select c_mktsegment, o_custkey, total, place, place / cast(max(place) over (partition by c_mktsegment) as double) as rank_percent from r""")
def _(t: Tables):
    o = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    return W.rank_percent(o, partition=["c_mktsegment"], entity=["o_custkey"], measure=money("o_totalprice"))


@query("cumulative_share", f"""
with s as (select p_brand, p_partkey, cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(28,2)) as revenue from lineitem join part on l_partkey = p_partkey group by 1, 2)
select p_brand, p_partkey, revenue, cast(sum(revenue) over (partition by p_brand order by revenue desc, p_partkey rows unbounded preceding) as double) / cast(sum(revenue) over (partition by p_brand) as double) as cumulative_share from s""")
def _(t: Tables):
    rev = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey").groupBy(
        "p_brand", F.col("l_partkey").alias("p_partkey")).agg(F.sum(money("l_extendedprice")).cast("decimal(28,2)").alias("revenue"))
    return W.cumulative_share(rev, partition=["p_brand"], measure="revenue", tie_break=["p_partkey"])


@query("window_total", f"select o_orderkey, o_custkey, cast(sum({TP}) over (partition by o_custkey) as decimal(28,2)) as customer_total from orders")
def _(t: Tables):
    return W.window_total(t.orders, partition=["o_custkey"], measure=money("o_totalprice"), name="customer_total").select("o_orderkey", "o_custkey", "customer_total")


@query("window_max_within", f"select o_orderkey, max({TP}) over (partition by o_orderstatus, o_orderpriority) as best from orders")
def _(t: Tables):
    return W.window_max_within(t.orders, partition=["o_orderstatus", "o_orderpriority"], measure=money("o_totalprice"), name="best").select("o_orderkey", "best")


@query("validity_from_observations", """
with o as (select user_id, event_type, case when event_type <> 'error' then ts end as ts from events)
select distinct user_id, event_type, coalesce(cast(min(ts) over (partition by user_id, event_type) as date), date '1900-01-01') as valid_from,
 coalesce(cast(max(ts) over (partition by user_id, event_type) as date), date '9999-12-31') as valid_to from o""")
def _(t: Tables):
    e = t.events.select("user_id", "event_type", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts"))
    return W.validity_from_observations(e, attrs=["user_id", "event_type"], date="ts")


@query("top_n_others", """
with s as (select l_returnflag, p_brand, sum(cast(l_extendedprice as decimal(18,2))) as total from lineitem join part on l_partkey = p_partkey group by 1, 2),
r as (select *, dense_rank() over (partition by l_returnflag order by total desc) as place from s)
select l_orderkey, l_linenumber, l.l_returnflag, part.p_brand, case when place <= 10 then part.p_brand else 'Others' end as name_with_others
from lineitem l join part on l_partkey = p_partkey join r on r.l_returnflag = l.l_returnflag and r.p_brand = part.p_brand""")
def _(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_extendedprice").join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    out = W.top_n_others(li, partition=["l_returnflag"], name="p_brand", measure=money("l_extendedprice"), n=10)
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "p_brand", "name_with_others")


@query("fill_forward_global", """
select event_id, last_value(case when event_type = 'purchase' then event_id end ignore nulls) over (order by ts, event_id rows unbounded preceding) as last_purchase from events""")
def _(t: Tables):
    e = t.events.select("event_id", "ts", F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("last_purchase"))
    return W.fill_forward_global(e, "last_purchase", order=["ts", "event_id"]).select("event_id", "last_purchase")


@query("fill_forward_group", """
select event_id, last_value(case when event_type = 'signup' then value end ignore nulls) over (partition by user_id order by cast(ts as date), event_id rows unbounded preceding) as level from events""")
def _(t: Tables):
    e = t.events.select("event_id", "user_id", F.date_format("ts", "dd/MM/yyyy").alias("day"), F.when(F.col("event_type") == "signup", F.col("value")).alias("level"))
    return W.fill_forward_group(e, "level", keys=["user_id"], order=["day", "event_id"], fmt="dd/MM/yyyy").select("event_id", "level")


@query("ytd_running_sum", f"""
select o_orderkey, c_nationkey, cast(sum({TP}) over (partition by c_nationkey, year(o_orderdate) order by o_orderdate, o_orderkey rows unbounded preceding) as decimal(28,2)) as ytd
from orders join customer on o_custkey = c_custkey""")
def _(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "dd/MM/yyyy").alias("day")).join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    return W.ytd_running_sum(o, keys=["c_nationkey"], order=["day", "o_orderkey"], measure=money("o_totalprice"), name="ytd", fmt="dd/MM/yyyy").select("o_orderkey", "c_nationkey", "ytd")


@query("in_out_running_count", """
with e as (select event_id, ts, value - 20 as v from events)
select event_id, cast(sum(case when v > 0 then 1 else 0 end) over (order by ts, event_id rows unbounded preceding) as bigint) as entries,
 cast(sum(case when v < 0 then 1 else 0 end) over (order by ts, event_id rows unbounded preceding) as bigint) as exits from e""")
def _(t: Tables):
    e = t.events.select("event_id", "ts", (F.col("value") - 20).alias("v"))
    return W.in_out_running_count(e, order=["ts", "event_id"], value="v", in_name="entries", out_name="exits").select("event_id", "entries", "exits")


@query("propagate_parent_keys", """
with e as (select event_id, case event_type when 'purchase' then 'H' when 'click' then 'L' when 'view' then 'LD' when 'signup' then 'TR' else '99' end as rt, cast(user_id as varchar) as a from events),
h as (select *, last_value(case when rt = 'H' then a end ignore nulls) over w as tid, last_value(case when rt = 'H' then event_id end ignore nulls) over w as header_event from e window w as (order by event_id rows unbounded preceding)),
l as (select *, last_value(case when rt = 'L' then tid || 'L' || a end ignore nulls) over w as lid, last_value(case when rt = 'TR' then tid || 'TR' || a end ignore nulls) over w as pid from h window w as (order by event_id rows unbounded preceding)),
d as (select *, last_value(case when rt = 'LD' then lid || 'LD' || a end ignore nulls) over (order by event_id rows unbounded preceding) as aid from l)
select event_id, rt, tid as transaction_id, lid as line_id, pid as payment_id, aid as adjustment_id, cast(header_event as varchar) as header_event from d""")
def _(t: Tables):
    kind = F.create_map(*[F.lit(x) for x in ("purchase", "H", "click", "L", "view", "LD", "signup", "TR")])
    e = t.events.select("event_id", F.coalesce(F.try_element_at(kind, F.col("event_type")), F.lit("99")).alias("rt"),
                        F.col("user_id").cast("string").alias("a"), F.col("event_id").cast("string").alias("id"), F.lit("feed").alias("file"))
    levels = [W.Level("transaction_id", "H", ("a",)), W.Level("line_id", "L", ("a",), "transaction_id"),
              W.Level("payment_id", "TR", ("a",), "transaction_id"), W.Level("adjustment_id", "LD", ("a",), "line_id")]
    out = W.propagate_parent_keys(e, record_type="rt", levels=levels, file_col="file", position_col="event_id", carried={"header_event": ("H", "id")})
    return out.select("event_id", "rt", "transaction_id", "line_id", "payment_id", "adjustment_id", "header_event")


@query("running_streak", """
with d as (select distinct user_id, cast(ts as date) as day from events), i as (select *, day - cast(row_number() over (partition by user_id order by day) as int) as island from d)
select user_id, day, cast(row_number() over (partition by user_id, island order by day) as int) as days_in_state from i""")
def _(t: Tables):
    return W.running_streak(t.events.withColumnRenamed("ts", "day"), keys=["user_id"], date="day")
