"""Weekly and daily facts: calendar-driven star joins, as-of look-ups and conditional counts.

The driver tables stand in for the operational ones: a nation is a store, a
customer a patient, an order a script, a line an item, a part a product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions import exprs as E
from lakeops.operators import aggs as A
from lakeops.operators import clean as C
from lakeops.operators import joins as J
from lakeops.operators import loads as D
from lakeops.operators import sets as S
from lakeops.operators import windows as W
from lakeops.plans.ordering import CAL_SQL, calendar
from lakeops.plans.relational import HIST_SQL, money, price_history
from lakeops.registry import Tables, query
from lakeops.session import fresh_path
from lakeops.sources import calendar as K
from lakeops.sources import sinks as O

AS_OF = "2001-08-01 00:00:00"
AUDIT_SQL = f"timestamp '{AS_OF}' as create_datetime, cast(null as timestamp) as update_datetime"
CUT = "1998-06-01"


def versions(df: DataFrame, key: str, *, sk: str) -> DataFrame:
    """Two validity versions of each row, with a surrogate key per version."""
    v = F.explode(F.array(F.lit(0), F.lit(1))).alias("v")
    day = lambda d: F.lit(d).cast("date")
    old = F.col("v") == 0
    return df.select("*", v).select(
        *df.columns, (F.col(key) * 2 + F.col("v")).cast("bigint").alias(sk),
        F.when(old, day("1900-01-01")).otherwise(day(CUT)).alias("valid_from"), F.when(old, day(CUT)).otherwise(day("9999-12-31")).alias("valid_to"),
        F.when(old, "N").otherwise("Y").alias("active_flag"))


def versions_sql(name: str, table: str, key: str, sk: str) -> str:
    return f"""{name} as (select {table}.*, cast({key} * 2 + v as bigint) as {sk}, case when v = 0 then date '1900-01-01' else date '{CUT}' end as valid_from,
  case when v = 0 then date '{CUT}' else date '9999-12-31' end as valid_to, case when v = 0 then 'N' else 'Y' end as active_flag from {table}, (values (0), (1)) x(v))"""


STORE_SQL = versions_sql("store", "nation", "n_nationkey", "sk_store")


def stores(t: Tables) -> DataFrame:
    return versions(t.nation.select("n_nationkey", "n_name", "n_regionkey"), "n_nationkey", sk="sk_store")


def as_of(fact: DataFrame, dim: DataFrame, on: str, date: str, take: str, how: str = "inner") -> DataFrame:
    """The surrogate key of the version valid on a date."""
    d = dim.select(on, take, F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"))
    return J.join_validity_half_open(fact, d, on=[on], date=date, start="_from", end="_to", how=how).drop("_from", "_to")


def scripts(t: Tables, *cols: str) -> DataFrame:
    """Orders with their store (the customer's nation) and day."""
    o = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), *cols)
    return o.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")), "o_custkey")


def items(t: Tables, line_cols: list, *order_cols: str) -> DataFrame:
    """Lines with their script."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), *line_cols)
    return lines.join(scripts(t, *order_cols), "o_orderkey")


SCRIPTS_SQL = "scripts as (select o.*, cast(o_orderdate as date) as day, c_nationkey as n_nationkey, c_name, c_mktsegment from orders o join customer on c_custkey = o_custkey)"
ITEMS_SQL = SCRIPTS_SQL + ", items as (select * from lineitem join scripts on l_orderkey = o_orderkey)"
WEEKS_SQL = CAL_SQL + ", weeks as (select date_value, financial_week_number as fin_week, financial_year as fin_year, week_commencing_date as week_start from calendar)"


def weeks(t: Tables) -> DataFrame:
    return calendar(t).select(F.col("date_value").alias("day"), F.col("financial_week_number").alias("fin_week"), F.col("financial_year").alias("fin_year"), F.col("week_commencing_date").alias("week_start"))


@query("fact_owings_weekly", f"""
with {WEEKS_SQL}, {ITEMS_SQL}
select fin_year, fin_week, n_name as store, p_brand, count(*) as n_items, count(distinct o_orderkey) as n_scripts, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(28,2)) as owing_quantity
from items join weeks on day = date_value join nation using (n_nationkey) join part on p_partkey = l_partkey group by 1, 2, 3, 4""")
def fact_owings_weekly(t: Tables, date_filter: Column | None = None):
    """Owed quantity per financial week, store and brand; ``date_filter`` limits a load to a period."""
    rows = items(t, [F.col("l_partkey").alias("p_partkey"), money("l_quantity").alias("qty")])
    rows = rows if date_filter is None else rows.where(date_filter)
    rows = J.join_star_inner(rows, [(weeks(t), "day"), (t.nation.select("n_nationkey", F.col("n_name").alias("store")), "n_nationkey"), (t.part.select("p_partkey", "p_brand"), "p_partkey")])
    # First per script, then per week: the distinct count needs no second distinct shuffle.
    return A.agg_two_level(rows, ["fin_year", "fin_week", "store", "p_brand"], ["o_orderkey"],
                           inner_aggs=[F.count(F.lit(1)).alias("n"), F.sum("qty").alias("q")],
                           outer_aggs=[F.sum("n").alias("n_items"), F.count(F.lit(1)).alias("n_scripts"), F.sum("q").cast("decimal(28,2)").alias("owing_quantity")])


FLAG_RULES = {"viewed": "kind = 'view'", "clicked": "kind = 'click'", "signed_up": "kind = 'signup'", "purchased": "kind = 'purchase'", "failed": "kind = 'error'",
              "high_value": "amount > 50", "returned_item": "kind = 'R'", "urgent": "urgent"}


@query("fact_endorsement_flags", f"""
with {STORE_SQL}, e as (select c_nationkey as n_nationkey, user_id as id, cast(ts as date) as day, event_type as kind, cast(value as decimal(18,2)) as amount, false as urgent from events join customer on c_custkey = user_id
  union all select c_nationkey, o_custkey, cast(o_orderdate as date), l_returnflag, cast(l_quantity as decimal(18,2)), o_orderpriority = '1-URGENT' from lineitem join orders on l_orderkey = o_orderkey join customer on c_custkey = o_custkey where upper(o_orderstatus) <> 'P')
select sk_store, cast(strftime(day, '%Y%m%d') as int) as sk_date, id, {", ".join(f"max(case when {c} then 'YES' end) as {n}" for n, c in FLAG_RULES.items())}
from e join store on e.n_nationkey = store.n_nationkey and valid_from <= day and day < valid_to group by 1, 2, 3""")
def fact_endorsement_flags(t: Tables):
    """Many endorsement rows of two sources folded to one row of YES flags per store, day and patient."""
    home = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("n_nationkey"))
    ev = t.events.select(F.col("user_id").alias("id"), F.to_date("ts").alias("day"), F.col("event_type").alias("kind"), money("value").alias("amount"), F.lit(False).alias("urgent")).join(home, "id")
    it = C.status_filter(items(t, [F.col("l_returnflag").alias("kind"), money("l_quantity").alias("amount")], "o_orderpriority", "o_orderstatus"), "o_orderstatus", exclude=["P"])
    it = it.select(F.col("o_custkey").alias("id"), "day", "kind", "amount", (F.col("o_orderpriority") == "1-URGENT").alias("urgent"), "n_nationkey")
    rows = S.union_all_rows(ev.select(*it.columns), it)
    # Fold before the store look-up: it depends on store and day only.
    folded = A.agg_flags_max(rows, ["n_nationkey", "day", "id"], FLAG_RULES)
    dated = as_of(folded, stores(t), "n_nationkey", "day", "sk_store")
    return dated.select("sk_store", E.date_key_int(F.col("day")).alias("sk_date"), "id", *FLAG_RULES)


@query("fact_adjustments", f"""
with {STORE_SQL}, {ITEMS_SQL} select sk_store, cast(strftime(day, '%Y%m%d') as int) as sk_date, l_returnflag as reason, count(*) as n, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(28,2)) as quantity
from items join store on store.n_nationkey = items.n_nationkey and active_flag = 'Y' where l_returnflag <> 'N' group by 1, 2, 3""")
def fact_adjustments(t: Tables):
    """Adjusted items per store, day and reason, against the current store version."""
    rows = items(t, ["l_returnflag", money("l_quantity").alias("qty")]).where("l_returnflag <> 'N'")
    daily = rows.groupBy("n_nationkey", "day", F.col("l_returnflag").alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.sum("qty").cast("decimal(28,2)").alias("quantity"))
    out = J.join_active_only(daily, stores(t), on="n_nationkey", flag="active_flag")
    return out.select("sk_store", E.date_key_int(F.col("day")).alias("sk_date"), "reason", "n", "quantity")


_EXP = "coalesce(case when o_orderkey % 5 = 0 then day + 90 end + 1, day + case when left(o_orderpriority, 1) in ('1', '2') then 180 else 28 end)"


@query("fact_script_funnel", f"""
with {STORE_SQL}, {ITEMS_SQL}, per as (select n_nationkey, o_orderkey, any_value(o_orderstatus) as st, count(*) as items, sum(case when l_returnflag = 'N' then 1 else 0 end) as new_items, sum(case when l_linestatus = 'F' then 1 else 0 end) as done, min({_EXP}) as expiry from items group by 1, 2),
tot as (select n_nationkey, count(*) as downloaded_scripts, sum(items) as downloaded_items, sum(case when st <> 'O' then 1 else 0 end) as dispensed_scripts, sum(case when st <> 'O' then new_items else 0 end) as dispensed_items,
  sum(case when st = 'F' then 1 else 0 end) as claimed_scripts, sum(case when st = 'F' then done else 0 end) as claimed_items, sum(case when st <> 'F' and expiry <= date '2001-08-01' then 1 else 0 end) as expired_before,
  sum(case when st <> 'F' and expiry between date '2001-08-02' and date '2001-08-15' then 1 else 0 end) as expired_14d, sum(case when st <> 'F' and expiry between date '2001-08-02' and date '2001-09-05' then 1 else 0 end) as expired_5w,
  sum(case when st <> 'F' and expiry between date '2001-08-02' and date '2001-10-10' then 1 else 0 end) as expired_10w from per group by 1)
select sk_store, n_name, {", ".join(f"cast(coalesce({c}, 0) as bigint) as {c}" for c in ("downloaded_scripts", "downloaded_items", "dispensed_scripts", "dispensed_items", "claimed_scripts", "claimed_items", "expired_before", "expired_14d", "expired_5w", "expired_10w"))}
from store left join tot on tot.n_nationkey = store.n_nationkey where active_flag = 'Y'""")
def fact_script_funnel(t: Tables):
    """Scripts and items downloaded, dispensed and claimed per store, and unclaimed scripts by expiry.

    One two-level aggregate gives all counts: per script first, then per store.
    """
    rows = items(t, ["l_returnflag", "l_linestatus"], "o_orderstatus", "o_orderpriority")
    stored = F.when(F.col("o_orderkey") % 5 == 0, F.date_add("day", 90))
    rows = rows.withColumn("expiry", E.expiry_date(F.left("o_orderpriority", F.lit(1)), stored, stored, F.lit(None).cast("date"), F.col("day"), codes=["1", "2"]))
    one = lambda c: F.when(F.expr(c), 1).otherwise(0)
    last = "date '2001-08-01'"
    names = {"downloaded_scripts": "1", "downloaded_items": "items", "dispensed_scripts": "if(st <> 'O', 1, 0)", "dispensed_items": "if(st <> 'O', new_items, 0)",
             "claimed_scripts": "if(st = 'F', 1, 0)", "claimed_items": "if(st = 'F', done, 0)", "expired_before": f"if(st <> 'F' and expiry <= {last}, 1, 0)"}
    names |= {n: f"if(st <> 'F' and expiry between {last} + 1 and {last} + {d}, 1, 0)" for n, d in (("expired_14d", 14), ("expired_5w", 35), ("expired_10w", 70))}
    totals = A.agg_two_level(rows, ["n_nationkey"], ["o_orderkey"],
                             inner_aggs=[F.max("o_orderstatus").alias("st"), F.count(F.lit(1)).alias("items"), F.sum(one("l_returnflag = 'N'")).alias("new_items"), F.sum(one("l_linestatus = 'F'")).alias("done"), F.min("expiry").alias("expiry")],
                             outer_aggs=[F.sum(F.expr(e)).alias(n) for n, e in names.items()])
    active = stores(t).where("active_flag = 'Y'").select("sk_store", "n_nationkey", "n_name")
    return J.join_left_default(active, totals, "n_nationkey", defaults={n: 0 for n in names}).select("sk_store", "n_name", *names)


CLINICAL = {"automatic": "st = 'F' and prio < '3'", "no_end": "prio = '5'", "removed": "st = 'P' and prio = '1'", "dispensed": "st = 'P' and prio <> '1'", "next_day": "st = 'O' and prio = '4'", "approved": "st = 'O'"}


@query("fact_clinical_checks", f"""
with {STORE_SQL}, {SCRIPTS_SQL}, b as (select min(day) as d1, max(day) as d2 from scripts), days as (select cast(unnest(generate_series(d1, d2, interval 1 day)) as date) as day from b),
s as (select n_nationkey, day, o_custkey, o_orderstatus as st, left(o_orderpriority, 1) as prio from scripts),
c as (select n_nationkey, day, {", ".join(f"count(distinct case when {c} then o_custkey end) as {n}" for n, c in CLINICAL.items())}, sum(case when prio = '2' then 1 else 0 end) as pmr from s group by 1, 2),
g as (select sk_store, days.day, coalesce(automatic, 0) as automatic, coalesce(no_end, 0) as no_end, coalesce(removed, 0) as removed, coalesce(dispensed, 0) as dispensed, coalesce(next_day, 0) as next_day, coalesce(approved, 0) as approved, coalesce(pmr, 0) as pmr
  from store cross join days left join c on c.n_nationkey = store.n_nationkey and c.day = days.day where active_flag = 'Y')
select sk_store, cast(strftime(day, '%Y%m%d') as int) as sk_date, cast(removed + dispensed + next_day + (approved - next_day) + automatic as int) as total_eligible, cast(removed + dispensed + next_day + (approved - next_day) as int) as total_add_queue,
 cast(automatic as int) as total_automatic, cast(no_end as int) as total_no_end, cast(removed as int) as total_removed, cast(dispensed as int) as total_dispensed, cast(next_day as int) as total_next_day, cast(approved - next_day as int) as total_single, cast(pmr as int) as total_pmr
from g where removed + dispensed + next_day + (approved - next_day) + automatic > 0 or pmr > 0""")
def fact_clinical_checks(t: Tables):
    """Checks per store and day on a dense store by day grid, with derived totals; all-zero days are left out."""
    base = scripts(t, "o_orderstatus", "o_orderpriority").select("n_nationkey", "day", "o_custkey", F.col("o_orderstatus").alias("st"), F.left("o_orderpriority", F.lit(1)).alias("prio"))
    # One pass: patients are folded to flags per store and day, then counted.
    per = base.groupBy("n_nationkey", "day", "o_custkey").agg(*[F.max(F.expr(c)).alias(n) for n, c in CLINICAL.items()], F.sum(F.expr("if(prio = '2', 1, 0)")).alias("pmr"))
    counts = per.groupBy("n_nationkey", "day").agg(*[F.sum(F.col(n).cast("int")).alias(n) for n in CLINICAL], F.sum("pmr").alias("pmr"))
    bounds = t.orders.agg(F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day"))
    grid = J.cross_join_grid(stores(t).where("active_flag = 'Y'").select("sk_store", "n_nationkey"), bounds)
    g = J.join_left_default(grid, counts, ["n_nationkey", "day"], defaults={n: 0 for n in [*CLINICAL, "pmr"]})
    queue = "removed + dispensed + next_day + (approved - next_day)"
    cols = {"total_eligible": f"{queue} + automatic", "total_add_queue": queue, "total_automatic": "automatic", "total_no_end": "no_end", "total_removed": "removed",
            "total_dispensed": "dispensed", "total_next_day": "next_day", "total_single": "approved - next_day", "total_pmr": "pmr"}
    return g.where(f"{queue} + automatic > 0 or pmr > 0").select(
        "sk_store", E.date_key_int(F.col("day")).alias("sk_date"), *[F.expr(f"cast({e} as int)").alias(n) for n, e in cols.items()])


@query("fact_daily_repeat", f"""
with {SCRIPTS_SQL}, p as (select max(day) - 730 as v_start, max(day) as v_end from scripts)
select day, n_nationkey, 'repeat' as source, count(*) as n from scripts, p where o_orderpriority >= '4' and day between v_start and v_end group by 1, 2
union all select cast(l_shipdate as date), n_nationkey, 'shipped', count(*) from lineitem join scripts on l_orderkey = o_orderkey, p where cast(l_shipdate as date) between v_start and v_end group by 1, 2""")
def fact_daily_repeat(t: Tables):
    """Repeat scripts and shipped items per day, two sources under one date range."""
    last = t.orders.agg(F.max("o_orderdate").cast("date").alias("v_end"))
    span = last.select(F.date_sub("v_end", 730).alias("v_start"), "v_end")
    repeat = scripts(t, "o_orderpriority").where("o_orderpriority >= '4'").select("day", "n_nationkey", F.lit("repeat").alias("source"))
    shipped = items(t, [F.col("l_shipdate").cast("date").alias("ship_day")]).select(F.col("ship_day").alias("day"), "n_nationkey", F.lit("shipped").alias("source"))
    rows = S.union_all_rows(repeat, shipped).where(F.col("day").between(span.select("v_start").scalar(), span.select("v_end").scalar()))
    return rows.groupBy("day", "n_nationkey", "source").agg(F.count(F.lit(1)).alias("n"))


CUSTV_SQL, SUPPV_SQL = versions_sql("cust", "customer", "c_custkey", "sk_customer"), versions_sql("supp", "supplier", "s_suppkey", "sk_supplier")


@query("fact_dispensed_detail", f"""
with {STORE_SQL}, {CUSTV_SQL}, {SUPPV_SQL}, {HIST_SQL}, {ITEMS_SQL}
select l_orderkey, l_linenumber, sk_store, sk_customer, sk_supplier, cast(strftime(day, '%Y%m%d') as int) as sk_date, cast(cast(l_quantity as decimal(18,2)) as decimal(15,5)) as quantity, unit_price, {AUDIT_SQL}
from items join store on store.n_nationkey = items.n_nationkey and store.valid_from <= day and day < store.valid_to join cust on cust.c_custkey = o_custkey and cust.valid_from <= day and day < cust.valid_to
join supp on s_suppkey = l_suppkey and supp.valid_from <= day and day < supp.valid_to join hist on h_partkey = l_partkey and hist.valid_from <= day and day < hist.valid_to where upper(o_orderstatus) <> 'P'""")
def fact_dispensed_detail(t: Tables):
    """Every dispensed item with the store, patient, supplier and price valid on its day."""
    rows = C.status_filter(items(t, ["l_linenumber", "l_partkey", F.col("l_suppkey").alias("s_suppkey"), money("l_quantity").alias("qty")], "o_orderstatus"), "o_orderstatus", exclude=["p"])
    rows = rows.withColumn("c_custkey", F.col("o_custkey"))
    rows = as_of(rows, stores(t), "n_nationkey", "day", "sk_store")
    rows = as_of(rows, versions(t.customer.select("c_custkey"), "c_custkey", sk="sk_customer"), "c_custkey", "day", "sk_customer")
    rows = as_of(rows, versions(t.supplier.select("s_suppkey"), "s_suppkey", sk="sk_supplier"), "s_suppkey", "day", "sk_supplier")
    rows = as_of(rows, price_history(t), "l_partkey", "day", "unit_price")
    return C.audit_columns(rows.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", "sk_store", "sk_customer", "sk_supplier",
                                       E.date_key_int(F.col("day")).alias("sk_date"), F.col("qty").cast("decimal(15,5)").alias("quantity"), "unit_price"), as_of=AS_OF)


@query("fact_special_share", f"""
with {WEEKS_SQL}, {ITEMS_SQL}, s as (select fin_year, fin_week, n_nationkey, cast(sum(case when l_returnflag = 'R' and p_type in ('PROMO', 'SMALL') then 1 else 0 end) as bigint) as special, count(*) as n
  from items join weeks on day = date_value join part on p_partkey = l_partkey group by 1, 2, 3)
select fin_year, fin_week, n_nationkey, special, n as total, cast(((20000 * special + n) // (2 * n)) / 100.0 as decimal(5,2)) as percent from s""")
def fact_special_share(t: Tables):
    """Share of special returned items per store and week."""
    promo = t.part.where("p_type in ('PROMO', 'SMALL')").select(F.col("p_partkey").alias("l_partkey"), F.lit(1).alias("special_part"))
    # A left join keeps all items; no item is read twice for the subset.
    rows = items(t, ["l_partkey", "l_returnflag"]).join(promo, "l_partkey", "left").join(weeks(t), "day")
    sums = rows.groupBy("fin_year", "fin_week", "n_nationkey").agg(F.sum(F.expr("if(l_returnflag = 'R' and special_part = 1, 1, 0)")).alias("special"), F.count(F.lit(1)).alias("total"))
    return sums.withColumn("percent", A.ratio_percent(F.col("special"), F.col("total")))


@query("fact_no_barcode", f"""
with {SCRIPTS_SQL} select o_orderkey, n_nationkey, day, case when u.event is not null then 'YES' else 'NO' end as seen_online, case when r.n is null then 'NO' else 'YES' end as has_accepted, coalesce(r.n, 0) as n_accepted
from scripts left join (select user_id, cast(min(event_id) as bigint) as event from events where event_type = 'purchase' group by 1) u on u.user_id = o_custkey left join (select l_orderkey, count(*) as n from lineitem where l_returnflag = 'A' group by 1) r on r.l_orderkey = o_orderkey
where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'N')""")
def fact_no_barcode(t: Tables):
    """Scripts without any scanned item, with YES/NO flags from two optional sources."""
    scanned = t.lineitem.where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("o_orderkey"))
    rows = J.anti_join_not_exists(scripts(t), scanned, "o_orderkey")
    online = t.events.where("event_type = 'purchase'").groupBy(F.col("user_id").alias("o_custkey")).agg(F.min("event_id").alias("event"))
    accepted = t.lineitem.where("l_returnflag = 'A'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(online, "o_custkey", "left").join(accepted, "o_orderkey", "left")
    yes = lambda c: F.when(c.isNotNull(), "YES").otherwise("NO")
    return rows.select("o_orderkey", "n_nationkey", "day", yes(F.col("event")).alias("seen_online"), yes(F.col("n")).alias("has_accepted"), F.coalesce("n", F.lit(0)).alias("n_accepted"))


@query("fact_instalments", f"""
with {STORE_SQL}, {ITEMS_SQL}, m as (select cast(unnest(generate_series((select date_trunc('month', min(day)) from scripts), (select date_trunc('month', max(day)) from scripts), interval 1 month)) as date) as month),
c as (select n_nationkey, cast(date_trunc('month', day) as date) as month, count(distinct o_orderkey) as scripts, count(distinct o_custkey) as patients, count(distinct case when (l_returnflag, l_linestatus) not in (('R', 'O')) then o_orderkey end) as collected from items group by 1, 2)
select sk_store, m.month, coalesce(scripts, 0) as scripts, coalesce(patients, 0) as patients, coalesce(collected, 0) as collected from store cross join m left join c on c.n_nationkey = store.n_nationkey and c.month = m.month where valid_from <= m.month and m.month < valid_to""")
def fact_instalments(t: Tables):
    """Scripts, patients and collected scripts per store and month, empty months included."""
    rows = items(t, ["l_returnflag", "l_linestatus"]).withColumn("month", F.trunc("day", "month"))
    per = rows.groupBy("n_nationkey", "month", "o_custkey", "o_orderkey").agg(F.max(F.expr("if(l_returnflag = 'R' and l_linestatus = 'O', 0, 1)")).alias("collected"))
    counts = A.agg_two_level(per, ["n_nationkey", "month"], ["o_custkey"], inner_aggs=[F.count(F.lit(1)).alias("s"), F.sum("collected").alias("c")],
                             outer_aggs=[F.sum("s").alias("scripts"), F.count(F.lit(1)).alias("patients"), F.sum("c").alias("collected")])
    months = t.orders.agg(F.trunc(F.min("o_orderdate").cast("date"), "month").alias("first_day"), F.trunc(F.max("o_orderdate").cast("date"), "month").alias("last_day"))
    grid = J.cross_join_grid(t.nation.select("n_nationkey"), months, name="month", step="1 month")
    grid = as_of(grid, stores(t), "n_nationkey", "month", "sk_store")
    return J.join_left_default(grid, counts, ["n_nationkey", "month"], defaults={"scripts": 0, "patients": 0, "collected": 0}).select("sk_store", "month", "scripts", "patients", "collected")


@query("fact_tariff_value", f"""
with {WEEKS_SQL}, {HIST_SQL}, {ITEMS_SQL} select fin_year, fin_week, n_nationkey, count(*) as n, cast(sum(cast(unit_price * cast(l_quantity as decimal(18,2)) as decimal(24,4))) as decimal(34,4)) as value
from items join weeks on day = date_value join hist on h_partkey = l_partkey and day between valid_from and valid_to where (l_returnflag, l_linestatus) not in (('A', 'F')) group by 1, 2, 3""")
def fact_tariff_value(t: Tables):
    """Quantity times the price valid on the day, closed ranges, per store and week."""
    rows = C.pair_not_in(items(t, ["l_partkey", "l_returnflag", "l_linestatus", money("l_quantity").alias("qty")]), "l_returnflag", "l_linestatus", [("A", "F")])
    priced = J.join_validity_closed(rows, price_history(t), on=["l_partkey"], date="day", start="valid_from", end="valid_to").join(weeks(t), "day")
    value = (F.col("unit_price") * F.col("qty")).cast("decimal(24,4)")
    return A.agg_group(priced, ["fin_year", "fin_week", "n_nationkey"], [F.count(F.lit(1)).alias("n"), F.sum(value).cast("decimal(34,4)").alias("value")])


@query("fact_support_daily", """
with l as (select user_id, event_type, ts, event_id, rank() over (partition by user_id, event_type order by ts desc) as r from events)
select user_id, event_type, event_id, case when c_custkey % 5 = 0 then 'NA' else c_name end as patient, case when c_custkey % 5 = 0 then 'NA' else c_mktsegment end as segment, cast(ts as date) as day, (select cast(max(ts) as date) from events) as max_date
from l join customer on c_custkey = user_id where r = 1""")
def fact_support_daily(t: Tables):
    """The newest event per patient and kind; names of patients who opted out are masked."""
    newest = A.agg_latest_per_key(t.events.select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], "ts")
    c = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    out = J.join_star_inner(newest, [(c, "user_id")])
    masked = lambda col: F.when(F.col("user_id") % 5 == 0, "NA").otherwise(F.col(col))
    out = out.select("user_id", "event_type", "event_id", masked("c_name").alias("patient"), masked("c_mktsegment").alias("segment"), F.to_date("ts").alias("day"))
    return J.join_scalar_params(out, t.events.agg(F.max("ts").cast("date").alias("max_date")))


@query("fact_emergency_reconcile", f"""
with {STORE_SQL}, {SCRIPTS_SQL} select a.o_orderkey, sk_store, a.day, case when b.o_orderkey is null then 'N' else 'Y' end as reconciled, b.day as reconciled_day, case when a.o_custkey % 7 = 0 then 'NA' else a.c_name end as patient
from scripts a left join scripts b on b.o_orderkey = a.o_orderkey + 1 and b.o_orderstatus = 'F' join store on store.n_nationkey = a.n_nationkey and valid_from <= a.day and a.day < valid_to where a.o_orderpriority = '1-URGENT'""")
def fact_emergency_reconcile(t: Tables):
    """Emergency supplies with the script that later reconciled them, if any."""
    urgent = scripts(t, "o_orderpriority").where("o_orderpriority = '1-URGENT'")
    later = t.orders.where("o_orderstatus = 'F'").select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_orderdate").cast("date").alias("reconciled_day"))
    rows = urgent.join(later, "o_orderkey", "left").join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    rows = as_of(rows, stores(t), "n_nationkey", "day", "sk_store")
    return rows.select("o_orderkey", "sk_store", "day", F.when(F.col("reconciled_day").isNull(), "N").otherwise("Y").alias("reconciled"), "reconciled_day",
                       F.when(F.col("o_custkey") % 7 == 0, "NA").otherwise(F.col("c_name")).alias("patient"))


@query("fact_claimed_vs_dispensed", f"""
with {WEEKS_SQL}, {ITEMS_SQL}, w as (select * from items join weeks on day = date_value),
a as (select fin_year, fin_week, n_nationkey, count(distinct o_orderkey) as claimed from w where l_linestatus = 'F' group by 1, 2, 3), b as (select fin_year, fin_week, n_nationkey, count(distinct o_orderkey) as dispensed from w where o_orderstatus <> 'P' group by 1, 2, 3),
c as (select fin_year, fin_week, n_nationkey, count(distinct o_custkey) as instalment_patients from w where l_returnflag = 'R' group by 1, 2, 3)
select fin_year, fin_week, n_nationkey, coalesce(claimed, 0) as claimed, coalesce(dispensed, 0) as dispensed, coalesce(instalment_patients, 0) as instalment_patients from a full join b using (fin_year, fin_week, n_nationkey) full join c using (fin_year, fin_week, n_nationkey)""")
def fact_claimed_vs_dispensed(t: Tables):
    """Three distinct counts per store and week, from one pass over the items."""
    rows = items(t, ["l_linestatus", "l_returnflag"], "o_orderstatus").join(weeks(t), "day")
    keys = ["fin_year", "fin_week", "n_nationkey"]
    per = rows.groupBy(*keys, "o_custkey", "o_orderkey").agg(
        F.max(F.expr("if(l_linestatus = 'F', 1, 0)")).alias("cl"), F.max(F.expr("if(o_orderstatus <> 'P', 1, 0)")).alias("di"), F.max(F.expr("if(l_returnflag = 'R', 1, 0)")).alias("ins"))
    out = A.agg_two_level(per, keys, ["o_custkey"], inner_aggs=[F.sum("cl").alias("cl"), F.sum("di").alias("di"), F.max("ins").alias("ins")],
                          outer_aggs=[F.sum("cl").alias("claimed"), F.sum("di").alias("dispensed"), F.sum("ins").cast("bigint").alias("instalment_patients")])
    return out.where("claimed > 0 or dispensed > 0 or instalment_patients > 0")


@query("fact_ostomy", f"""
with {STORE_SQL}, {ITEMS_SQL}, d as (select sk_store, l_suppkey, day, day - ((cast(dayofweek(day) as int) + 6) % 7) as week_anchor, case when l_returnflag = 'R' then 'Y' else 'N' end as sent, case when l_quantity > 25 then 'Y' else 'N' end as eligible
  from items join store on store.n_nationkey = items.n_nationkey and day between valid_from and valid_to - 1),
s as (select week_anchor, sk_store, count(*) as dispensed, sum(case when sent = 'Y' then 1 else 0 end) as sent, sum(case when eligible = 'Y' then 1 else 0 end) as eligible from d group by 1, 2)
select week_anchor, sk_store, dispensed, cast(sent as bigint) as sent, cast(eligible as bigint) as eligible, cast(sum(dispensed) over w as bigint) as total_dispensed, cast(sum(sent) over w as bigint) as total_sent, cast(sum(eligible) over w as bigint) as total_eligible from s window w as (partition by week_anchor)""")
def fact_ostomy(t: Tables):
    """Supplies per store and week next to the totals of all stores."""
    days = K.week_anchor_calendar(calendar(t)).select(F.col("date_value").alias("day"), "week_anchor")
    rows = items(t, ["l_returnflag", "l_quantity"]).select("n_nationkey", "day", F.expr("if(l_returnflag = 'R', 1, 0)").alias("sent"), F.expr("if(l_quantity > 25, 1, 0)").alias("eligible"))
    # Down to one row per store and day before the version and week look-ups.
    daily = rows.groupBy("n_nationkey", "day").agg(F.count(F.lit(1)).alias("dispensed"), F.sum("sent").alias("sent"), F.sum("eligible").alias("eligible"))
    daily = as_of(daily, stores(t), "n_nationkey", "day", "sk_store").join(days, "day")
    return A.agg_total_vs_part(daily, ["week_anchor"], ["sk_store"], {n: F.col(n) for n in ("dispensed", "sent", "eligible")})


@query("fact_overstock", f"""
with d as (select distinct user_id, event_type, cast(ts as date) as day from events), i as (select *, day - cast(row_number() over (partition by user_id, event_type order by day) as int) as island from d),
s as (select *, cast(row_number() over (partition by user_id, event_type, island order by day) as int) as days_in_state from i),
old as (select user_id, event_type, day, days_in_state from (select *, row_number() over (partition by user_id, event_type order by day desc) as r from s where day < date '2024-01-20') where r = 1),
new as (select user_id, event_type, day, days_in_state from (select *, row_number() over (partition by user_id, event_type order by day desc) as r from s where day >= date '2024-01-20') where r = 1)
select coalesce(n.user_id, o.user_id) as user_id, coalesce(n.event_type, o.event_type) as event_type, coalesce(n.day, o.day) as day, coalesce(n.days_in_state, o.days_in_state) as days_in_state,
 case when o.user_id is null then timestamp '2001-08-01' else timestamp '2001-01-01' end as create_datetime, case when o.user_id is not null and n.user_id is not null then timestamp '2001-08-01' end as update_datetime
from old o full join new n on n.user_id = o.user_id and n.event_type = o.event_type""")
def fact_overstock(t: Tables):
    """Days in a row in a state, kept up to date per key by SCD-1."""
    streak = W.running_streak(t.events.withColumnRenamed("ts", "day"), keys=["user_id", "event_type"], date="day")
    keys = ["user_id", "event_type"]

    def last(where):
        return A.agg_latest_per_key(streak.where(where), keys, "day", ties="one")

    target = C.audit_columns(last("day < date '2024-01-20'"), as_of="2001-01-01 00:00:00")
    return D.scd1_upsert(last("day >= date '2024-01-20'"), target, keys=keys, update_cols=["day", "days_in_state"], as_of=AS_OF)


@query("fact_owing_redemption", f"""
with {STORE_SQL}, {ITEMS_SQL} select sk_store, p_brand, day, count(*) as n, cast(sum(case when l_linestatus = 'O' then cast(l_quantity as decimal(18,2)) else 0 end) as decimal(28,2)) as outstanding, cast(sum(case when l_linestatus = 'F' then cast(l_quantity as decimal(18,2)) else 0 end) as decimal(28,2)) as redeemed
from items join part on p_partkey = l_partkey join store on store.n_nationkey = items.n_nationkey and valid_from <= day and day < valid_to where (l_returnflag, l_linestatus) not in (('N', 'O'), ('A', 'F')) group by 1, 2, 3""")
def fact_owing_redemption(t: Tables):
    """Owed and redeemed quantity per store, brand and day."""
    rows = C.pair_not_in(items(t, [F.col("l_partkey").alias("p_partkey"), "l_returnflag", "l_linestatus", money("l_quantity").alias("qty")]), "l_returnflag", "l_linestatus", [("N", "O"), ("A", "F")])
    rows = as_of(rows.join(t.part.select("p_partkey", "p_brand"), "p_partkey"), stores(t), "n_nationkey", "day", "sk_store")
    sums = A.agg_conditional_sum(rows, ["sk_store", "p_brand", "day"], {"n": ("true", "1"), "outstanding": ("l_linestatus = 'O'", "qty"), "redeemed": ("l_linestatus = 'F'", "qty")})
    return sums.withColumns({c: F.col(c).cast("decimal(28,2)") for c in ("outstanding", "redeemed")})


@query("fact_new_patients", """
with f as (select user_id, c_nationkey, cast(strftime(ts, '%Y%m') as int) as month_key, cast(min(ts) as date) as first_date from events join customer on c_custkey = user_id where event_type <> 'error' group by 1, 2, 3)
select month_key, c_nationkey, count(distinct user_id) as patients, min(first_date) as first_seen from f group by 1, 2""")
def fact_new_patients(t: Tables):
    """Patients first seen per store and month; a month is replaced as a whole when it is loaded again."""
    e = t.events.where("event_type <> 'error'").select("user_id", "ts", F.date_format("ts", "yyyyMM").cast("int").alias("month_key"))
    first = A.agg_min_date_per_entity(e, ["user_id", "month_key"], "ts")
    first = first.join(t.customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey"), "user_id")
    per = first.groupBy("c_nationkey", "month_key").agg(F.count(F.lit(1)).alias("patients"), F.min("first_date").alias("first_seen"))
    dest = fresh_path(t.spark, "new_patients")
    per = per.select("c_nationkey", "patients", "first_seen", "month_key")
    O.write_partitioned_append(per.withColumn("patients", F.lit(0).cast("bigint")), dest, keys=["month_key"])
    return O.delete_where_and_append(per, dest, key="month_key")


@query("fact_preference_override", f"""
with {STORE_SQL}, {CUSTV_SQL}, {SUPPV_SQL}, {HIST_SQL}, {ITEMS_SQL}
select distinct sk_store, sk_supplier, cust.sk_customer % 2 as customer_version, unit_price, l_partkey from items join store on store.n_nationkey = items.n_nationkey and store.valid_from <= day and day < store.valid_to
join cust on cust.c_custkey = o_custkey and cust.valid_from <= day and day < cust.valid_to join supp on s_suppkey = l_suppkey and supp.valid_from <= day and day < supp.valid_to join hist on h_partkey = l_partkey and hist.valid_from <= day and day < hist.valid_to where l_discount >= 0.05""")
def fact_preference_override(t: Tables):
    """Distinct overrides with four dimensions as of the day."""
    rows = items(t, ["l_partkey", F.col("l_suppkey").alias("s_suppkey"), "l_discount"]).where("l_discount >= 0.05D").withColumn("c_custkey", F.col("o_custkey"))
    rows = as_of(rows, stores(t), "n_nationkey", "day", "sk_store")
    rows = as_of(rows, versions(t.customer.select("c_custkey"), "c_custkey", sk="sk_customer"), "c_custkey", "day", "sk_customer")
    rows = as_of(rows, versions(t.supplier.select("s_suppkey"), "s_suppkey", sk="sk_supplier"), "s_suppkey", "day", "sk_supplier")
    rows = as_of(rows, price_history(t), "l_partkey", "day", "unit_price")
    return A.distinct_rows(rows.withColumn("customer_version", F.col("sk_customer") % 2), ["sk_store", "sk_supplier", "customer_version", "unit_price", "l_partkey"])


RISK = [("MAS", "o_orderpriority like '1%' and o_orderstatus <> 'F'", 10, "count(*)"), ("UCF", "o_orderpriority like '2%' and o_orderstatus not in ('F', 'X')", 10, "count(*)"),
        ("CONS", "o_orderpriority like '3%' and o_orderstatus <> 'F'", 10, "count(*)")]


@query("fact_at_risk", f"""
with {STORE_SQL}, {ITEMS_SQL}, p as (select max(day) as sunday from scripts), owed as (select distinct l_orderkey from lineitem where l_returnflag = 'R' and l_linestatus = 'O' union select l_orderkey from lineitem where l_quantity > 48)
{" union all ".join(f"select '{n}' as kind, sk_store, count(*) as scripts from scripts join store on store.n_nationkey = scripts.n_nationkey and active_flag = 'Y', p where {c} and day <= sunday - {d} group by 2" for n, c, d, _ in RISK)}
union all select 'MCR', sk_store, count(distinct o_custkey) from items join store on store.n_nationkey = items.n_nationkey and active_flag = 'Y', p where o_orderpriority like '4%' and day <= sunday - 35 and o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R' and l_linestatus = 'O') group by 2
union all select 'AMS', sk_store, count(distinct o_orderkey) from items join store on store.n_nationkey = items.n_nationkey and active_flag = 'Y', p where o_orderpriority like '5%' and day <= sunday - 35 and o_orderstatus <> 'F' and o_orderkey not in (select l_orderkey from owed) group by 2""")
def fact_at_risk(t: Tables):
    """Unclaimed scripts per store past their age limit, in five kinds; those still owed are left out."""
    sunday = t.orders.agg(F.max("o_orderdate").cast("date").alias("d")).scalar()
    base = scripts(t, "o_orderpriority", "o_orderstatus")
    flagged = t.lineitem.where("l_returnflag = 'R' and l_linestatus = 'O'").select(F.col("l_orderkey").alias("o_orderkey"))
    owed = S.union_distinct_rows(flagged, t.lineitem.where("l_quantity > 48").select(F.col("l_orderkey").alias("o_orderkey")))
    aged = lambda d: F.col("day") <= F.date_sub(sunday, d)
    kind = C.case_rules([(F.expr(c) & aged(d), n) for n, c, d, _ in RISK])
    plain = base.withColumn("kind", kind).where("kind is not null").groupBy("kind", "n_nationkey").agg(F.count(F.lit(1)).alias("scripts"))
    with_items = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    mcr = J.anti_join_not_in(J.semi_join_in(base.where(F.expr("o_orderpriority like '4%'") & aged(35)), with_items, ["o_orderkey"]), flagged, "o_orderkey")
    ams = J.anti_join_not_in(J.semi_join_in(base.where(F.expr("o_orderpriority like '5%' and o_orderstatus <> 'F'") & aged(35)), with_items, ["o_orderkey"]), owed, "o_orderkey")
    mcr = mcr.groupBy(F.lit("MCR").alias("kind"), "n_nationkey").agg(F.count_distinct("o_custkey").alias("scripts"))
    ams = ams.groupBy(F.lit("AMS").alias("kind"), "n_nationkey").agg(F.count_distinct("o_orderkey").alias("scripts"))
    rows = S.union_all_rows(plain, mcr, ams)
    return J.join_active_only(rows, stores(t), on="n_nationkey", flag="active_flag").select("kind", "sk_store", "scripts")


@query("fact_stock_value", f"""
with {HIST_SQL} select s_nationkey, p_brand, count(*) as n, cast(sum(cast(unit_price * qty as decimal(28,4))) as decimal(38,4)) as stock_value from (select l_partkey, l_suppkey, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(28,2)) as qty from lineitem group by 1, 2)
join part on p_partkey = l_partkey join supplier on s_suppkey = l_suppkey join hist on h_partkey = l_partkey and scd_active_flag = 'Y' group by 1, 2""")
def fact_stock_value(t: Tables):
    """Stock per product and supplier at the current price, by brand and nation."""
    stock = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum(money("l_quantity")).cast("decimal(28,2)").alias("qty"))
    rows = J.join_active_only(stock, price_history(t), on="l_partkey", flag="scd_active_flag")
    rows = J.join_star_inner(rows, [(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"), (t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")])
    value = (F.col("unit_price") * F.col("qty")).cast("decimal(28,4)")
    return rows.groupBy("s_nationkey", "p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum(value).cast("decimal(38,4)").alias("stock_value"))
