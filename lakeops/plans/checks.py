"""Data-quality rules over the customers and orders, with faults planted by rule."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators import quality as Q
from lakeops.operators import sets as S
from lakeops.plans.relational import money
from lakeops.registry import Tables, query
from lakeops.session import fresh_path
from lakeops.sources import sinks as W

FAULTY_SQL = """raw as (select o_orderkey, case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then ' ' else o_orderstatus end as status,
 case when o_orderkey % 17 = 0 then 'x' || o_custkey else cast(o_custkey as varchar) end as cust, case when o_orderkey % 19 = 0 then '5' else strftime(o_orderdate, '%Y-%m-%d') end as day,
 cast(o_totalprice as decimal(18,2)) as price, case when o_orderkey % 23 = 0 then 0 else o_orderkey end as code, case when o_custkey % 29 = 0 then o_custkey + 100000000 else o_custkey end as custkey from orders)"""


def faulty(t: Tables):
    """Orders as text with planted faults."""
    k = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, " ").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 17 == 0, F.concat(F.lit("x"), F.col("o_custkey").cast("string"))).otherwise(F.col("o_custkey").cast("string")).alias("cust"),
        F.when(k % 19 == 0, "5").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"), money("o_totalprice").alias("price"),
        F.when(k % 23 == 0, 0).otherwise(k).alias("code"), F.when(F.col("o_custkey") % 29 == 0, F.col("o_custkey") + 100000000).otherwise(F.col("o_custkey")).alias("custkey"))


def rules(t: Tables) -> list[dict]:
    """One rule of each kind."""
    return [
        {"name": "status_present", "kind": "not_null", "column": "status", "dimension": "Integrity"},
        {"name": "status_known", "kind": "in_list", "column": "status", "values": ["O", "F"], "dimension": "Conformity"},
        {"name": "cust_digits", "kind": "regex", "column": "cust", "pattern": "DIGITS", "dimension": "Conformity"},
        {"name": "day_date", "kind": "type", "column": "day", "type": "date", "dimension": "Conformity"},
        {"name": "day_length", "kind": "length", "column": "day", "low": 10, "high": 10, "dimension": "Conformity"},
        {"name": "price_range", "kind": "range", "column": "price", "low": 2000, "high": 490000, "dimension": "Accuracy"},
        {"name": "code_unique", "kind": "unique", "column": "code", "dimension": "Integrity"},
        {"name": "cust_exists", "kind": "reference", "column": "custkey", "frame": t.customer, "key": "c_custkey", "dimension": "Integrity"},
    ]


CHECKS_SQL = f"""{FAULTY_SQL}, checked as (select raw.*, cast(coalesce(status is not null and trim(status) <> '', false) as int) as dq_check_status_present, cast(coalesce(status in ('O', 'F'), false) as int) as dq_check_status_known,
 cast(coalesce(regexp_matches(cust, '^[0-9]+$'), false) as int) as dq_check_cust_digits, cast(coalesce(try_cast(day as date) is not null, false) as int) as dq_check_day_date,
 cast(coalesce(length(day) = 10, false) as int) as dq_check_day_length, cast(coalesce(price between 2000 and 490000, false) as int) as dq_check_price_range,
 cast(count(*) over (partition by code) = 1 as int) as dq_check_code_unique, cast(custkey in (select c_custkey from customer) as int) as dq_check_cust_exists from raw)"""
NAMES = ["status_present", "status_known", "cust_digits", "day_date", "day_length", "price_range", "code_unique", "cust_exists"]
DIMS = ["Integrity", "Conformity", "Conformity", "Conformity", "Conformity", "Accuracy", "Integrity", "Integrity"]
FINAL_SQL = "least(" + ", ".join(f"dq_check_{n}" for n in NAMES) + ")"
ERRORS_SQL = "concat_ws(',', " + ", ".join(f"case when dq_check_{n} = 0 then '{n}' end" for n in NAMES) + ")"


def checked(t: Tables):
    return Q.dq_row_rules(faulty(t), rules(t))


@query("rule_predefined", """
select c_custkey, upper('  ' || lower(c_name)) as up, lower(c_name) as low, trim('  ' || c_name || ' ') as clean, regexp_replace(c_name, '[^0-9]', '', 'g') as digits, case when c_custkey % 3 = 0 then null else c_mktsegment end as blank from customer""")
def _(t: Tables):
    df = t.customer.select("c_custkey", F.concat(F.lit("  "), F.lower("c_name")).alias("up"), F.col("c_name").alias("low"), F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("clean"),
                           F.col("c_name").alias("digits"), F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise(F.col("c_mktsegment")).alias("blank"))
    return Q.rule_predefined(df, {"upper": "up", "lower": "low", "trim": ["clean"], "digits_only": "digits", "null_if_blank": "blank"})


@query("rule_expression", """
select c_custkey, regexp_replace(c_name, '#0*', '-', 'g') as c_name, case when c_nationkey > 20 then -1 else c_nationkey end as c_nationkey from customer""")
def _(t: Tables):
    return Q.rule_expression(t.customer.select("c_custkey", "c_name", "c_nationkey"), [
        {"type": "regex", "columns": "c_name", "expression": "#0*", "value": "-"},
        {"type": "value", "columns": "c_nationkey", "expression": "{c} > 20", "value": -1}])


@query("rule_complex", """
select c_custkey, split_part(c_name, '#', 1) as kind, split_part(c_name, '#', 2) as number, c_mktsegment || '/' || cast(c_nationkey as varchar) as segment_nation, n_name as nation
from customer join nation on c_nationkey = n_nationkey""")
def _(t: Tables):
    out = Q.rule_complex(t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"), [
        {"type": "split", "column": "c_name", "separator": "#", "into": ["kind", "number"], "drop": True},
        {"type": "concat", "columns": "c_mktsegment,c_nationkey", "separator": "/", "into": "segment_nation"},
        {"type": "lookup", "column": "c_nationkey", "frame": t.nation, "key": "n_nationkey", "value": "n_name", "into": "nation"}])
    return out.drop("c_mktsegment", "c_nationkey")


@query("validate_schema", """
select 'c_phone' as "column", 'missing' as difference, 'string' as expected, cast(null as varchar) as found, count(*) as affected_rows from customer
union all select 'c_acctbal', 'extra', null, 'double', count(c_acctbal) from customer union all select 'c_nationkey', 'type', 'bigint', 'int', cast(0 as bigint) from region where r_regionkey = 0
union all select 'c_name', 'type', 'int', 'string', sum(case when try_cast(c_name as int) is null then 1 else 0 end)::bigint from customer""")
def _(t: Tables):
    return Q.validate_schema(t.customer, T.StructType.fromDDL("c_custkey bigint, c_name int, c_nationkey bigint, c_mktsegment string, c_phone string"))


@query("dq_row_rules", f"with {CHECKS_SQL} select * from checked")
def _(t: Tables):
    return checked(t).select(*faulty(t).columns, *[f"dq_check_{n}" for n in NAMES])


@query("dq_final_flag", f"with {CHECKS_SQL} select o_orderkey, {FINAL_SQL} as dq_final from checked")
def _(t: Tables):
    return Q.dq_final_flag(checked(t)).select("o_orderkey", "dq_final")


@query("dq_error_text", f"with {CHECKS_SQL} select o_orderkey, {ERRORS_SQL} as dq_errors from checked")
def _(t: Tables):
    return Q.dq_error_text(checked(t)).select("o_orderkey", "dq_errors")


@query("dq_split", f"""
with {CHECKS_SQL}, f as (select o_orderkey, {FINAL_SQL} as ok from checked)
select 'enforced good' as part, o_orderkey from f where ok = 1 union all select 'enforced bad', o_orderkey from f where ok = 0 union all select 'open good', o_orderkey from f""")
def _(t: Tables):
    flagged = Q.dq_final_flag(checked(t))
    good, bad = Q.dq_split(flagged, enforce=True)
    rest, _ = Q.dq_split(flagged, enforce=False, store=False)
    return S.union_all_rows(*[d.select(F.lit(n).alias("part"), "o_orderkey") for n, d in (("enforced good", good), ("enforced bad", bad), ("open good", rest))])


@query("quarantine_bad_rows", f"with {CHECKS_SQL} select o_orderkey, status, cust, {ERRORS_SQL} as dq_errors from checked where {FINAL_SQL} = 0")
def _(t: Tables):
    _, bad = Q.dq_split(Q.dq_error_text(Q.dq_final_flag(checked(t))), enforce=True, store=False)
    return W.quarantine_bad_rows(bad.select("o_orderkey", "status", "cust", "dq_errors"), fresh_path(t.spark, "quarantine"), run="20010801")


PCT = "cast(((20000 * {p} + {w}) // (2 * {w})) / 100.0 as decimal(5,2))"
REPORT_SQL = "report as (" + " union all ".join(
    f"select '{n}' as rule, '{d}' as dimension, count(*) as checked, cast(sum(1 - dq_check_{n}) as bigint) as failed from checked" for n, d in zip(NAMES, DIMS)) + ")"


@query("dq_rule_report", f"with {CHECKS_SQL}, {REPORT_SQL} select *, {PCT.format(p='failed', w='checked')} as failed_percent from report")
def _(t: Tables):
    return Q.dq_rule_report(checked(t), rules(t))


@query("write_report_json", f"with {CHECKS_SQL}, {REPORT_SQL} select *, {PCT.format(p='failed', w='checked')} as failed_percent from report")
def _(t: Tables):
    return W.write_report_json(Q.dq_rule_report(checked(t), rules(t)), fresh_path(t.spark, "report"))


@query("dq_dimensions", f"""
with {CHECKS_SQL}, {REPORT_SQL}, s as (select dimension, cast(sum(checked) as bigint) as checked, cast(sum(failed) as bigint) as failed from report group by 1)
select d.dimension, coalesce(checked, 0) as checked, coalesce(failed, 0) as failed, coalesce({PCT.format(p='(checked - failed)', w='checked')}, cast(0 as decimal(5,2))) as passed_percent
from (values ('Conformity'), ('Integrity'), ('Consistency'), ('Accuracy')) d(dimension) left join s on s.dimension = d.dimension""")
def _(t: Tables):
    return Q.dq_dimensions(Q.dq_rule_report(checked(t), rules(t)))


@query("dq_counts", f"with {CHECKS_SQL} select count(*) as total_rows, cast(sum(1 - {FINAL_SQL}) as bigint) as bad_rows, cast(sum({FINAL_SQL}) as bigint) as good_rows from checked")
def _(t: Tables):
    return Q.dq_counts(Q.dq_final_flag(checked(t)))


@query("drop_helper_columns", f"with {FAULTY_SQL} select * from raw")
def _(t: Tables):
    return Q.drop_helper_columns(Q.dq_error_text(Q.dq_final_flag(checked(t)))).select(*faulty(t).columns)
