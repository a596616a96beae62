"""Incremental loads, slowly changing dimensions and control tables over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import control as L
from lakeops.operators import loads as D
from lakeops.operators import sets as S
from lakeops.plans.relational import CUSTOMER_V2_SQL, customer_v2
from lakeops.registry import Tables, query
from lakeops.session import fresh_path

RUN1, RUN2, RUN3 = "2001-01-01 00:00:00", "2001-08-01 00:00:00", "2001-09-01 00:00:00"
TRACKED = ["c_name", "c_nationkey", "c_mktsegment"]
CUST = ["c_custkey", *TRACKED]
DIFF_SQL = " or ".join(f"s.{c} is distinct from t.{c}" for c in TRACKED)


def first_dim(t: Tables):
    """The customer dimension after its first load."""
    return D.new_dimension(t.customer.select(*CUST), as_of=RUN1)


DIM_SQL = f"""dim as (select c_custkey, c_name, c_nationkey, c_mktsegment, 'Y' as scd_active_flag, timestamp '1900-01-01 00:00:00' as record_start_date,
 timestamp '9999-12-31 11:59:59' as record_end_date, timestamp '{RUN1}' as create_datetime, cast(null as timestamp) as update_datetime from customer)"""


@query("incremental_since", """
select o_orderkey, o_orderdate from orders where o_orderdate > (select max(o_orderdate) from orders where o_orderstatus = 'P' and o_orderdate < timestamp '1999-06-01')""")
def _(t: Tables):
    loaded = t.orders.where("o_orderstatus = 'P' and o_orderdate < timestamp_ntz '1999-06-01'")
    return D.incremental_since(t.orders.select("o_orderkey", "o_orderdate"), loaded, ts="o_orderdate")


@query("scd1_upsert", f"""
with {CUSTOMER_V2_SQL}, tgt as (select c_custkey, c_name, c_nationkey, c_mktsegment, timestamp '{RUN1}' as create_datetime, cast(null as timestamp) as update_datetime from customer)
select coalesce(t.c_custkey, s.c_custkey) as c_custkey, case when s.c_custkey is null then t.c_name else s.c_name end as c_name, case when s.c_custkey is null then t.c_nationkey else s.c_nationkey end as c_nationkey,
 case when s.c_custkey is null then t.c_mktsegment else s.c_mktsegment end as c_mktsegment, coalesce(t.create_datetime, timestamp '{RUN2}') as create_datetime,
 case when s.c_custkey is not null and t.c_custkey is not null then timestamp '{RUN2}' end as update_datetime from tgt t full join v2 s on t.c_custkey = s.c_custkey""")
def _(t: Tables):
    tgt = t.customer.select(*CUST, F.lit(RUN1).cast("timestamp_ntz").alias("create_datetime"), F.lit(None).cast("timestamp_ntz").alias("update_datetime"))
    return D.scd1_upsert(customer_v2(t), tgt, keys=["c_custkey"], update_cols=TRACKED, as_of=RUN2)


@query("scd2_start_date", f"""
with {CUSTOMER_V2_SQL} select v2.*, case when c.c_custkey is not null then timestamp '{RUN2}' else timestamp '1900-01-01 00:00:00' end as record_start_date from v2 left join customer c on c.c_custkey = v2.c_custkey""")
def _(t: Tables):
    return D.scd2_start_date(customer_v2(t), first_dim(t), keys=["c_custkey"], as_of=RUN2)


@query("scd2_changed_rows", f"with {CUSTOMER_V2_SQL} select s.* from v2 s left join customer t on t.c_custkey = s.c_custkey where t.c_custkey is null or {DIFF_SQL}")
def _(t: Tables):
    return D.scd2_changed_rows(customer_v2(t), first_dim(t), cols=CUST)


def scd2_sql(end: str) -> str:
    """Target after one SCD-2 load of the second delivery, deletions marked by the BUILDING segment."""
    return f"""{CUSTOMER_V2_SQL}, {DIM_SQL}, chg as (select s.* from v2 s left join customer t on t.c_custkey = s.c_custkey where t.c_custkey is null or {DIFF_SQL}),
after as (select d.c_custkey, d.c_name, d.c_nationkey, d.c_mktsegment, case when h.c_custkey is null then 'Y' else 'N' end as scd_active_flag, record_start_date,
  case when h.c_custkey is null then record_end_date else {end} end as record_end_date, create_datetime, case when h.c_custkey is not null then timestamp '{RUN2}' end as update_datetime
  from dim d left join chg h on h.c_custkey = d.c_custkey
 union all select c_custkey, c_name, c_nationkey, c_mktsegment, 'Y', case when c_custkey in (select c_custkey from customer) then timestamp '{RUN2}' else timestamp '1900-01-01 00:00:00' end,
  timestamp '9999-12-31 11:59:59', timestamp '{RUN2}', cast(null as timestamp) from chg where c_mktsegment <> 'BUILDING')"""


def _scd2(t: Tables, end_mode: str):
    dim = first_dim(t)
    changed = D.scd2_changed_rows(customer_v2(t), dim, cols=CUST)
    dated = D.scd2_start_date(changed, dim, keys=["c_custkey"], as_of=RUN2)
    return D.scd2_upsert(dated, dim, keys=["c_custkey"], cols=TRACKED, as_of=RUN2, end_mode=end_mode, delete_flag=("c_mktsegment", "BUILDING"))


@query("scd2_upsert", f"""
with {scd2_sql(f"timestamp '{RUN2}'")} select 'contiguous' as end_mode, * from after
union all select 'minus_1_day', * replace (case when scd_active_flag = 'N' then record_end_date - interval 1 day else record_end_date end as record_end_date) from after""")
def _(t: Tables):
    return S.union_all_rows(*[_scd2(t, m).select(F.lit(m).alias("end_mode"), "*") for m in ("contiguous", "minus_1_day")])


@query("scd1_folder", f"""
with {CUSTOMER_V2_SQL} select coalesce(s.c_custkey, t.c_custkey) as c_custkey, case when s.c_custkey is null then t.c_name else s.c_name end as c_name,
 coalesce(s.c_mktsegment, t.c_mktsegment) as c_mktsegment, coalesce(case when t.c_custkey is not null then timestamp '{RUN1}' end, timestamp '{RUN2}') as create_datetime,
 case when s.c_custkey is not null and t.c_custkey is not null then timestamp '{RUN2}' end as update_datetime from customer t full join v2 s on t.c_custkey = s.c_custkey""")
def _(t: Tables):
    path, cols = fresh_path(t.spark, "scd1_folder"), ["c_custkey", "c_name", "c_mktsegment"]
    D.scd1_folder(t.customer.select(*cols), path, keys=["c_custkey"], as_of=RUN1, partition_keys=["c_mktsegment"])
    out = D.scd1_folder(customer_v2(t).select(*cols), path, keys=["c_custkey"], as_of=RUN2, partition_keys=["c_mktsegment"])
    return out.select(*cols, "create_datetime", "update_datetime")


@query("scd2_folder", f"""
with {CUSTOMER_V2_SQL}, chg as (select s.* from v2 s left join customer t on t.c_custkey = s.c_custkey where t.c_custkey is null or {DIFF_SQL})
select d.c_custkey, d.c_name, d.c_nationkey, d.c_mktsegment, case when h.c_custkey is null then 'Y' else 'N' end as scd_active_flag, timestamp '1900-01-01 00:00:00' as record_start_date,
 case when h.c_custkey is null then timestamp '9999-12-31 11:59:59' else timestamp '{RUN2}' end as record_end_date from customer d left join chg h on h.c_custkey = d.c_custkey
union all select c_custkey, c_name, c_nationkey, c_mktsegment, 'Y', timestamp '{RUN2}', timestamp '9999-12-31 11:59:59' from chg""")
def _(t: Tables):
    path = fresh_path(t.spark, "scd2_folder")
    D.scd2_folder(t.customer.select(*CUST), path, keys=["c_custkey"], compare=TRACKED, as_of=RUN1)
    D.scd2_folder(customer_v2(t), path, keys=["c_custkey"], compare=TRACKED, as_of=RUN2)
    # The same delivery once more changes nothing.
    out = D.scd2_folder(customer_v2(t), path, keys=["c_custkey"], compare=TRACKED, as_of=RUN3)
    return out.select(*CUST, "scd_active_flag", "record_start_date", "record_end_date")


@query("merge_count", f"""
with {CUSTOMER_V2_SQL} select case when t.c_custkey is null then 'insert' when s.c_custkey is null then 'keep' when {DIFF_SQL} then 'update' else 'keep' end as action, count(*) as n
from customer t full join v2 s on t.c_custkey = s.c_custkey group by 1""")
def _(t: Tables):
    return D.merge_count(customer_v2(t), first_dim(t), keys=["c_custkey"], cols=TRACKED, kind="scd2")


@query("merge_update_only", f"""
with {CUSTOMER_V2_SQL} select c.c_custkey, case when v2.c_custkey is not null and c.c_mktsegment = 'MACHINERY' then v2.c_nationkey else c.c_nationkey end as c_nationkey, c.c_mktsegment
from customer c left join v2 on v2.c_custkey = c.c_custkey""")
def _(t: Tables):
    return D.merge_update_only(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), customer_v2(t), on=["c_custkey"], set_cols=["c_nationkey"], where="c_mktsegment = 'MACHINERY'")


@query("merge_upsert_column", f"""
with {CUSTOMER_V2_SQL} select coalesce(c.c_custkey, v2.c_custkey) as c_custkey, c.c_name, case when v2.c_custkey is not null then v2.c_nationkey else c.c_nationkey end as c_nationkey
from customer c full join v2 on v2.c_custkey = c.c_custkey""")
def _(t: Tables):
    return D.merge_upsert_column(t.customer.select("c_custkey", "c_name", "c_nationkey"), customer_v2(t), keys=["c_custkey"], col="c_nationkey")


@query("upsert_by_keys", f"""
with {CUSTOMER_V2_SQL} select * from v2 union all select c_custkey, c_name, c_nationkey, c_mktsegment from customer where c_custkey not in (select c_custkey from v2)""")
def _(t: Tables):
    return D.upsert_by_keys(customer_v2(t), t.customer.select(*CUST), keys=["c_custkey"])


# ---- control tables, derived from the orders and events

WM_SQL = "select 'orders' as source, o_orderpriority as feed, cast(year(o_orderdate) as int) as batch, max(o_orderdate) as last_time from orders where {} group by 2, 3"


def _watermarks(t: Tables, where: str):
    return t.orders.where(where).groupBy(F.lit("orders").alias("source"), F.col("o_orderpriority").alias("feed"), F.year("o_orderdate").alias("batch")).agg(F.max("o_orderdate").alias("last_time"))


@query("watermark_append", WM_SQL.format("year(o_orderdate) < 2000") + " union all " + WM_SQL.format("year(o_orderdate) >= 2000"))
def _(t: Tables):
    return L.watermark_append(_watermarks(t, "year(o_orderdate) < 2000"), _watermarks(t, "year(o_orderdate) >= 2000"))


@query("scan_active_files_by_watermark", """
with f as (select 'orders_' || o_custkey as file_name, max(o_orderdate) as modified_at from orders group by 1),
w as (select 'orders_' || o_custkey as file_name, max(o_orderdate) as last_processed_at from orders where o_orderstatus = 'F' and o_orderpriority <> '1-URGENT' group by 1)
select f.file_name, modified_at, coalesce(last_processed_at, timestamp '1900-01-01') as last_processed_at from f left join w on f.file_name = w.file_name
where modified_at > coalesce(last_processed_at, timestamp '1900-01-01')""")
def _(t: Tables):
    from lakeops.sources.files import scan_active_files_by_watermark
    name = F.concat(F.lit("orders_"), F.col("o_custkey").cast("string")).alias("file_name")
    files = t.orders.groupBy(name).agg(F.max("o_orderdate").alias("modified_at"))
    seen = t.orders.where("o_orderstatus = 'F' and o_orderpriority <> '1-URGENT'").groupBy(name).agg(F.max("o_orderdate").alias("last_processed_at"))
    marks = seen.withColumn("stage", F.lit("curate")).unionByName(files.select("file_name", F.col("modified_at").alias("last_processed_at"), F.lit("other").alias("stage")))
    return scan_active_files_by_watermark(files, marks, stage="curate")


_LOG = "process_stage string, entity_name string, batch_id string, status string, source_count bigint, target_count bigint"


@query("run_log_append", """
with d as (select o_custkey, o_orderstatus, count(*) as n, max(o_orderkey) as k from orders group by 1, 2)
select 'CurateStaging' as process_stage, 'c' || o_custkey || o_orderstatus as entity_name, 'h' || o_custkey as batch_id, 'Success' as status, n as source_count, k as target_count from d
union all select 'CurateStaging', 'c' || o_custkey || o_orderstatus, 'i' || o_custkey, 'Success', s, s from (select *, cast(sum(n) over (partition by o_custkey) as bigint) as s from d)
union all select 'CurateStore', 'customer ' || o_custkey, 's' || o_custkey, 'Success', cast(sum(n) as bigint), cast(sum(n) as bigint) from d group by o_custkey""")
def _(t: Tables):
    d = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("k"))
    name = F.concat(F.lit("c"), F.col("o_custkey").cast("string"), "o_orderstatus")
    # One customer has three statuses at most, so these lists have at most three items.
    per = d.groupBy("o_custkey").agg(
        F.sum("n").alias("s"),
        F.concat(F.lit("['"), F.array_join(F.collect_list(F.concat(F.lit('("'), name, F.lit('", "'), F.col("n").cast("string"), F.lit('", "'), F.col("k").cast("string"), F.lit('")'))), "', '"), F.lit("']")).alias("tuples"),
        F.concat(F.lit('["'), F.array_join(F.collect_list(name), '","'), F.lit('"]')).alias("names"))
    key = F.col("o_custkey").cast("string")
    total = F.col("s").cast("string")

    def entries(stage, entity, batch, target):
        return per.select(F.lit(stage).alias("process_stage"), entity.alias("entity_name"), F.concat(F.lit(batch), key).alias("batch_id"),
                          F.lit('"Success"').alias("status"), total.alias("source_count"), target.alias("target_count"))

    log = t.spark.createDataFrame([], _LOG)
    log = L.run_log_append(log, entries("'CurateStaging'", F.col("tuples"), "h", total), load_type="History")
    log = L.run_log_append(log, entries("'CurateStaging'", F.col("names"), "i", total), load_type="Incremental")
    text = F.concat(F.lit('{"rows":1,"written":'), total, F.lit("}"))
    return L.run_log_append(log, entries("CurateStore", F.concat(F.lit("['customer "), key, F.lit("']")), "s", text), load_type="Other")


_FLAGS_SQL = """log as (select case when o_custkey % 2 = 0 then 'Store_' else 'Product_' end || o_custkey as feed_name, strftime(min(o_orderdate), '%Y-%m-%d') as start_date, strftime(max(o_orderdate), '%Y-%m-%d') as end_date,
 case when o_custkey % 3 = 0 then 'N' else 'Y' end as active_flag, case when o_custkey % 5 = 0 then 'Y' else 'N' end as restart_flag from orders group by o_custkey)"""


def _restart_log(t: Tables):
    k = F.col("o_custkey")
    return t.orders.groupBy("o_custkey").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("start_date"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("end_date")).select(
        F.concat(F.when(k % 2 == 0, "Store_").otherwise("Product_"), k.cast("string")).alias("feed_name"), "start_date", "end_date",
        F.when(k % 3 == 0, "N").otherwise("Y").alias("active_flag"), F.when(k % 5 == 0, "Y").otherwise("N").alias("restart_flag"))


@query("control_flag_transition", f"""
with {_FLAGS_SQL}
select 'restart_begin' as step, feed_name, start_date, end_date, case when active_flag = 'Y' and restart_flag = 'N' then 'A' else active_flag end as active_flag,
 case when restart_flag = 'Y' and feed_name like 'Store%' then 'R' when active_flag = 'N' and restart_flag = 'Y' then 'A' else restart_flag end as restart_flag from log
union all select 'restart_begin', 'Store_next', '', '', 'P', 'N'
union all select 'restart_end', feed_name, start_date, end_date, active_flag, restart_flag from log union all select 'restart_end', 'Store_next', '', '', 'N', 'N'
union all select 'run_begin', feed_name, start_date, end_date, case when active_flag = 'Y' and restart_flag = 'N' then case when feed_name like 'Store%' then 'N' else 'A' end else active_flag end, restart_flag from log
union all select 'run_begin', 'Store_next', '', '', 'P', 'N'
union all select 'run_end', feed_name, start_date, end_date, case when active_flag = 'Y' and restart_flag = 'N' and feed_name like 'Store%' then 'N' else active_flag end, restart_flag from log
union all select 'run_end', 'Store_next', '', '', 'Y', 'N'""")
def _(t: Tables):
    log, steps = _restart_log(t), []
    for kind in ("restart", "run"):
        begun = L.control_flag_transition(log, feed="Store", event=f"{kind}_begin", run="Store_next")
        ended = L.control_flag_transition(begun, feed="Store", event=f"{kind}_end", run="Store_next")
        steps += [begun.select(F.lit(f"{kind}_begin").alias("step"), "*"), ended.select(F.lit(f"{kind}_end").alias("step"), "*")]
    return S.union_all_rows(*steps)


@query("next_extract_window", f"with {_FLAGS_SQL} select feed_name, cast(end_date as date) + 1 as start_date, cast(end_date as date) + 30 as end_date from log where feed_name like 'Product%'")
def _(t: Tables):
    return L.next_extract_window(_restart_log(t), feed="Product", days=30)


_STAGE = {"curate_stage": "true", "curate_standard": "o_totalprice < 495000", "curate_store": "o_totalprice < 485000", "curate_warehouse": "o_totalprice < 475000"}
_COUNTS_SQL = "counts as (" + " union all ".join(f"select o_custkey, '{s}' as stage, count(*) as n from orders where {c} group by 1" for s, c in _STAGE.items()) + ")"


def _recon_sql(strict: bool) -> str:
    ok = "a = b and b = c and c = d" if strict else "c = d and a > 0"
    return f"""select {str(strict).lower()} as strict, w.o_custkey, s.stage, case s.stage when 'curate_stage' then a when 'curate_standard' then b when 'curate_store' then c else d end as n,
 case when s.stage = 'curate_standard' then a - b end as bad_rows, case when {ok} then 'equal' else 'not equal' end as verdict from w, (values ('curate_stage'), ('curate_standard'), ('curate_store'), ('curate_warehouse')) s(stage)"""


@query("stage_reconciliation", f"""
with {_COUNTS_SQL}, w as (select o_custkey, cast(coalesce(sum(case when stage = 'curate_stage' then n end), 0) as bigint) as a, cast(coalesce(sum(case when stage = 'curate_standard' then n end), 0) as bigint) as b,
 cast(coalesce(sum(case when stage = 'curate_store' then n end), 0) as bigint) as c, cast(coalesce(sum(case when stage = 'curate_warehouse' then n end), 0) as bigint) as d from counts group by 1)
{_recon_sql(True)} union all {_recon_sql(False)}""")
def _(t: Tables):
    # One pass counts all four stages.
    wide = t.orders.groupBy("o_custkey").agg(*[F.sum(F.when(F.expr(c), 1).otherwise(0)).alias(s) for s, c in _STAGE.items()])
    counts = wide.unpivot(["o_custkey"], list(_STAGE), "stage", "n")
    bad = wide.select("o_custkey", (F.col("curate_stage") - F.col("curate_standard")).alias("bad_rows"))
    return S.union_all_rows(*[L.stage_reconciliation(counts, bad, keys=["o_custkey"], strict=s).select(F.lit(s).alias("strict"), "*") for s in (True, False)])


@query("batch_reconciliation", """
with e as (select cast(ts as date) as batch, event_type, user_id from events)
select batch, event_type, messages, total_rows, unique_rows from (select batch, event_type, count(*) as total_rows, count(distinct user_id) as unique_rows, cast(sum(count(*)) over (partition by batch) as bigint) as messages from e group by 1, 2)""")
def _(t: Tables):
    e = t.events.select(F.to_date("ts").alias("batch"), "event_type", "user_id")
    return L.batch_reconciliation(e, entity="event_type", batch="batch")


_BAD_SQL = "select cast(year(o_orderdate) as int) as batch_id, left(o_orderpriority, 1) as feed_id, o_orderstatus as entity, cast(sum(case when o_totalprice > 480000 and o_custkey % 4 = 1 then 1 else 0 end) as bigint) as bad_rows from orders where {} group by 1, 2, 3"


def _bad(t: Tables, where: str):
    return t.orders.where(where).groupBy(F.year("o_orderdate").alias("batch_id"), F.left("o_orderpriority", F.lit(1)).alias("feed_id"), F.col("o_orderstatus").alias("entity")).agg(
        F.sum(F.when(F.expr("o_totalprice > 480000 and o_custkey % 4 = 1"), 1).otherwise(0)).alias("bad_rows"))


@query("bad_row_register", _BAD_SQL.format("year(o_orderdate) = 1995") + f" union all select batch_id, case when feed_id in ('1', '3', '5') then '1,3,5' else feed_id end, entity, bad_rows from ({_BAD_SQL.format('year(o_orderdate) > 1995')}) where bad_rows > 0")
def _(t: Tables):
    return L.bad_row_register(_bad(t, "year(o_orderdate) = 1995"), _bad(t, "year(o_orderdate) > 1995"), joint_ids=["1", "3", "5"])


@query("feed_counts_row", "select 'lineitem' as source_name, (select count(*) from lineitem) as source_count, 'returned' as destination_name, (select count(*) from lineitem where l_returnflag = 'R') as destination_count")
def _(t: Tables):
    return L.feed_counts_row(t.lineitem, t.lineitem.where("l_returnflag = 'R'"), names=("lineitem", "returned"))
