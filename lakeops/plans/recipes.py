"""The two recipe runners over the driver tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakeops.operators import sets as S
from lakeops.plans.checks import CHECKS_SQL, FINAL_SQL, faulty, rules
from lakeops.plans.loading import RUN1, RUN2
from lakeops.plans.recipe import run_cleanse, run_recipe
from lakeops.plans.relational import CUSTOMER_V2_SQL, customer_v2, money
from lakeops.registry import Tables, query
from lakeops.session import fresh_path
from lakeops.sources import sinks as O

ETL_SQL = """o as (select o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') as day, cast(o_totalprice as decimal(18,2)) as price from orders where o_totalprice > 5000 and o_orderstatus <> 'P'),
j as (select o.*, c_nationkey, c_mktsegment from o join customer on c_custkey = o_custkey),
u as (select * from j where c_nationkey < 12 union all select * from j where c_nationkey >= 10), d as (select distinct * from u),
w as (select d.*, row_number() over (partition by c_nationkey order by day, o_orderkey) as place, cast(sum(price) over (partition by c_nationkey, left(day, 4) order by day, o_orderkey rows unbounded preceding) as decimal(28,2)) as ytd,
 n_name as nation from d left join nation on n_nationkey = c_nationkey)"""


def etl_steps(path: str) -> list[dict]:
    """A recipe that touches the main kinds of steps."""
    return [
        {"card_type": "apply_filter", "input_table": "raw_orders", "output_table": "o", "filter": ["price > 5000", "o_orderstatus <> 'P'"]},
        {"card_type": "apply_join", "left_table_name": "o", "right_table_name": "customers", "temp_table_name": "j", "join_type": "inner", "on_sql_condition": "l.o_custkey = r.c_custkey",
         "select_sql": ["l.*", "r.c_nationkey", "r.c_mktsegment"], "partition_left_col": "o_custkey", "partition_right_col": "c_custkey"},
        {"card_type": "apply_sparksql_4m_tmp", "query": "select * from j where c_nationkey < 12", "table_name": "j1"},
        {"card_type": "apply_sparksql_4m_tmp", "query": "select * from j where c_nationkey >= 10", "table_name": "j2"},
        {"card_type": "apply_union", "input_tables": "j1,j2", "output_table": "u"},
        {"card_type": "apply_dedupe", "input_table": "u", "output_table": "d", "columns": "o_orderkey", "dedupe_by": "day"},
        {"card_type": "apply_window", "input_table": "d", "output_table": "w0", "partition_list": ["c_nationkey"], "order_column": "day", "expression": "row_number()", "new_column_name": "place"},
        {"card_type": "ytd_running_sum_group", "input_table": "w0", "output_table": "w1", "partition_column_list": "c_nationkey", "order_by_column": "day", "calculation_column_name": "price", "ytd_column_name": "ytd"},
        {"card_type": "table_lookup", "source_table": "w1", "cache_table": "nations", "commom_lookup_name": "c_nationkey", "output_column_name": "nation", "output_table": "w"},
        {"card_type": "apply_order_by", "input_table": "w", "output_table": "sorted", "order_by_conditions": "c_nationkey, place desc"},
        {"card_type": "write_dataset", "query": "select * from sorted", "data_path": path, "partition_key_columns": "o_orderstatus", "label": "orders"},
        {"card_type": "apply_group_by", "input_table": "w", "output_table": "g", "group_by_columns": "nation,o_orderstatus", "aggregate_conditions": ["count(*) as n", "cast(max(ytd) as decimal(28,2)) as best"]},
        {"card_type": "apply_merge_count", "new_data_table": "moved", "dim_data_table": "known", "merge_data_table": "merged", "primaryKeyColumn": "c_custkey", "merge_type": "SCD1", "as_of": RUN2, "label": "customers"},
    ]


def _run(t: Tables, backwards: bool = False):
    raw = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), money("o_totalprice").alias("price"))
    cust = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    known = cust.withColumns({"create_datetime": F.lit(RUN1).cast("timestamp_ntz"), "update_datetime": F.lit(None).cast("timestamp_ntz")})
    steps = etl_steps(fresh_path(t.spark, "recipe"))
    return run_recipe(t.spark, steps[::-1] if backwards else steps, {
        "raw_orders": raw, "customers": t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), "known": known, "moved": customer_v2(t),
        "nations": t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")}, by_dependency=backwards)


@query("recipe_etl", f"""
with {ETL_SQL}, {CUSTOMER_V2_SQL} select 'group' as part, nation as a, o_orderstatus as b, count(*) as n, max(ytd) as best from w group by 2, 3 union all select 'summary', 'orders', 'written', count(*), null from w
union all select 'summary', 'customers', 'changed', count(*), null from v2 s left join customer t on t.c_custkey = s.c_custkey where t.c_custkey is null or s.c_name is distinct from t.c_name or s.c_nationkey is distinct from t.c_nationkey or s.c_mktsegment is distinct from t.c_mktsegment""")
def recipe_etl(t: Tables):
    """Filter, join, union, dedupe, windows, look-up, write and merge as one recipe."""
    out = _run(t)
    groups = out["g"].select(F.lit("group").alias("part"), F.col("nation").alias("a"), F.col("o_orderstatus").alias("b"), "n", "best")
    summary = out["run_summary"].select(F.lit("summary").alias("part"), F.col("step").alias("a"), F.col("kind").alias("b"), F.col("row_count").alias("n"))
    return S.union_padded(groups, summary)


@query("run_recipe", f"with {ETL_SQL} select o_orderkey, c_nationkey, c_mktsegment, place, ytd, nation from w")
def run_recipe_detail(t: Tables):
    """The detail rows of the same recipe."""
    return _run(t)["sorted"].select("o_orderkey", "c_nationkey", "c_mktsegment", "place", F.col("ytd").cast("decimal(28,2)").alias("ytd"), "nation")


def _stamp(df, *, value: str):
    return df.withColumn("batch", F.lit(value))


@query("recipe_cleanse", f"""
with {CHECKS_SQL}, f as (select *, {FINAL_SQL} as ok from checked)
select 'row' as part, cast(o_orderkey as varchar) as a, status as b, case when price > 300000 then 'high' else 'low' end as c, custkey as n from f where ok = 1 and price < 450000
union all select 'key', sha256(cast(o_orderkey as varchar) || chr(1) || status), null, null, null from f where ok = 1 and price < 450000
union all select 'quarantined feed', cast(o_orderkey as varchar), status, null, custkey from raw
union all select 'total', 'total', 'UK', 'b1', count(*) from f union all select 'total', 'bad', 'UK', 'b1', count(*) from f where ok = 0
union all select 'by status', status, null, null, count(*) from f where ok = 1 and price < 450000 group by 2""")
def recipe_cleanse(t: Tables):
    """Standardise, check, quarantine, derive, rename and write one feed to two targets."""
    base = fresh_path(t.spark, "cleanse")
    config = {
        "run": 20010801, "quarantine_path": f"{base}/bad",
        "rules_engine": {"predefined": {"trim": "status"}, "expression": [{"type": "regex", "columns": "day", "expression": r"\s+", "value": ""}]},
        "data_quality": {"row_based_rules": {"enforce": True, "rules": rules(t)}},
        "data_source": {"data_type": "PARQUET", "path": f"{base}/in"}, "generate_key": {"column_name": "row_key", "columns": ["o_orderkey", "status"]},
        "filters": ["price < 450000"], "constants": {"country": "UK"},
        "derived": [("level", [("price > 300000", "high")], "low")], "rename": {"custkey": "customer"},
        "columns": ["o_orderkey", "status", "day", "price", "customer", "country", "level", "record_timestamp", "row_key"],
        "custom": [(_stamp, {"value": "b1"})],
        "data_destination": [{"path": f"{base}/good", "keys": ["status"]}, {"path": f"{base}/counts", "query": "select status, count(*) as n from {source} group by status"}],
    }
    faulty(t).write.parquet(f"{base}/in")
    out = run_cleanse(None, config, t.spark)
    # The same feed with a test that it fails goes to quarantine as a whole.
    strict = config | {"data_quality": config["data_quality"] | {"enforced_tests": ["bad_rows = 0"]}, "data_destination": [], "quarantine_path": f"{base}/strict"}
    stopped = run_cleanse(None, strict, t.spark)
    feed = stopped["quarantined_feed"].unionByName(stopped["result"].select("o_orderkey", "status", F.col("customer").alias("custkey")), allowMissingColumns=True)
    feed = feed.select(F.lit("quarantined feed").alias("part"), F.col("o_orderkey").cast("string").alias("a"), F.col("status").alias("b"), F.col("custkey").alias("n"))
    keys = out[f"{base}/good"].select(F.lit("key").alias("part"), F.col("row_key").alias("a"))
    rows = out[f"{base}/good"].select(F.lit("row").alias("part"), F.col("o_orderkey").cast("string").alias("a"), F.col("status").alias("b"), F.col("level").alias("c"), F.col("customer").alias("n"))
    totals = out["counts"].unpivot([], ["total_rows", "bad_rows"], "a", "n").select(F.lit("total").alias("part"), F.regexp_replace("a", "_rows", "").alias("a"), F.lit("UK").alias("b"), F.lit("b1").alias("c"), "n")
    by = out[f"{base}/counts"].select(F.lit("by status").alias("part"), F.col("status").alias("a"), "n")
    return S.union_padded(rows, totals, by, keys, feed)


@query("recipe_by_dependency", f"with {ETL_SQL} select o_orderkey, c_nationkey, c_mktsegment, place, ytd, nation from w")
def recipe_by_dependency(t: Tables):
    """The same recipe, its steps listed backwards and put in order by what they read."""
    return _run(t, backwards=True)["sorted"].select("o_orderkey", "c_nationkey", "c_mktsegment", "place", F.col("ytd").cast("decimal(28,2)").alias("ytd"), "nation")


@query("recipe_resume", """
select 'table' as part, o_orderstatus as a, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as price from orders group by 2
union all select 'written', 'appended', count(*), null from orders union all select 'written', 'totals', count(distinct o_orderstatus), null from orders""")
def recipe_resume(t: Tables):
    """A recipe that fails after its first write and is run again: the append is in the table once."""
    base = fresh_path(t.spark, "resume")
    orders = t.orders.select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("price"))
    steps = [
        {"card_type": "write_dataset", "query": "select * from todays_orders", "data_path": f"{base}/orders", "partition_key_columns": "o_orderstatus", "label": "appended"},
        {"card_type": "read_table", "query": "select o_orderstatus, cast(sum(price) as decimal(28,2)) as price, count(*) as n from todays_orders group by 1", "temp_table_name": "order_totals"},
        {"card_type": "write_delta", "query": "select * from order_totals", "data_path": f"{base}/totals", "label": "totals"},
    ]
    broken = [*steps[:2], {**steps[2], "query": "select * from order_totals_of_nobody"}]
    try:
        run_recipe(t.spark, broken, {"todays_orders": orders}, ledger=f"{base}/ledger")
    except AnalysisException:
        pass
    done = run_recipe(t.spark, steps, {"todays_orders": orders}, ledger=f"{base}/ledger")["run_summary"]
    written = t.spark.read.schema("o_orderkey bigint, price decimal(18,2), o_orderstatus string").parquet(f"{base}/orders")
    rows = written.groupBy(F.col("o_orderstatus").alias("a")).agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(28,2)").alias("price")).select(F.lit("table").alias("part"), "*")
    return S.union_padded(rows, done.select(F.col("kind").alias("part"), F.col("step").alias("a"), F.col("row_count").alias("n")))


@query("recipe_storage", """
with base as (select o_orderkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as price, cast(year(o_orderdate) as int) as yr from orders),
kept as (select * from base where not (o_orderstatus = 'P' or yr = 1995) and yr >= 1993), src as (select * from kept where o_orderkey % 2 = 0), tgt as (select o_orderkey, 'X' as o_orderstatus, -price as price, yr from base where yr >= 1997)
select 'merged' as part, * from src union all select 'merged', * from tgt where o_orderkey not in (select o_orderkey from src)
union all select 'dataset', c_custkey, c_mktsegment, cast(null as decimal(18,2)), cast(null as int) from customer union all select 'written', count(*), 'stored', null, null from base""")
def recipe_storage(t: Tables):
    """Write a partitioned table, delete rows and partitions, drop old ones, read it back, read run folders and merge by key."""
    base = fresh_path(t.spark, "storage")
    orders = t.orders.select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("price"), F.year("o_orderdate").alias("yr"))
    O.write_run_folder(t.customer.select("c_custkey", "c_mktsegment"), f"{base}/runs", run_date="20010801", run_time="000000")
    steps = [
        {"card_type": "write_delta", "query": "select * from all_orders", "data_path": f"{base}/table", "partition_key_columns": "yr", "label": "stored"},
        {"card_type": "delete_delta", "data_path": f"{base}/table", "partition_key": "yr", "query": "o_orderstatus = 'P' or yr = 1995"},
        {"card_type": "clean_delta", "data_path": f"{base}/table", "partition_key": "yr", "cutoff": 1993},
        {"card_type": "read_delta", "data_path": f"{base}/table", "output_table": "kept_orders"},
        {"card_type": "read_table", "query": "select * from kept_orders where o_orderkey % 2 = 0", "temp_table_name": "even_orders"},
        {"card_type": "read_dataset", "data_type": "PARQUET", "data_path": f"{base}/runs", "extraction_logic": ["20010801"], "schema": "c_custkey bigint, c_mktsegment string", "table_name": "run_customers"},
        {"card_type": "upsert_table", "query": "select * from even_orders", "target_table": "late_orders", "key_columns": "o_orderkey", "output_table": "merged_orders"},
    ]
    late = orders.where("yr >= 1997").withColumns({"o_orderstatus": F.lit("X"), "price": (-F.col("price")).cast("decimal(18,2)")})
    out = run_recipe(t.spark, steps, {"all_orders": orders, "late_orders": late})
    merged = out["merged_orders"].select(F.lit("merged").alias("part"), "o_orderkey", "o_orderstatus", "price", "yr")
    customers = out["run_customers"].select(F.lit("dataset").alias("part"), F.col("c_custkey").alias("o_orderkey"), F.col("c_mktsegment").alias("o_orderstatus"))
    written = out["run_summary"].select(F.col("kind").alias("part"), F.col("row_count").alias("o_orderkey"), F.col("step").alias("o_orderstatus"))
    return S.union_padded(merged, customers, written)
