"""Row checks, recipes and expressions on small frames."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions import exprs as E
from lakeops.operators import clean as C
from lakeops.operators import quality as Q
from lakeops.plans.recipe import run_recipe
from lakeops.sources import calendar as K


def frame(spark):
    return spark.createDataFrame([(1, "a@b.uk", "5"), (2, None, "x"), (2, "bad", None), (None, " ", "7")], "id int, mail string, n string")


RULES = [
    {"name": "mail", "kind": "regex", "column": "mail", "pattern": "EMAIL", "dimension": "Conformity"},
    {"name": "n", "kind": "type", "column": "n", "type": "int", "dimension": "Accuracy"},
    {"name": "id", "kind": "unique", "column": "id", "dimension": "Integrity"},
]


def test_null_results_fail_and_counts_add_up(spark):
    df = Q.dq_error_text(Q.dq_final_flag(Q.dq_row_rules(frame(spark), RULES)))
    assert sorted(r["dq_errors"] for r in df.collect()) == ["", "mail", "mail,n,id", "mail,n,id"]
    good, bad = Q.dq_split(df, enforce=True)
    counts = Q.dq_counts(df).first()
    assert (good.count(), bad.count()) == (counts["good_rows"], counts["bad_rows"]) and counts["total_rows"] == 4


def test_report_of_an_empty_frame(spark):
    df = Q.dq_final_flag(Q.dq_row_rules(frame(spark).where("id = 99"), RULES))
    report = Q.dq_rule_report(df, RULES).collect()
    assert {(r["checked"], r["failed"], r["failed_percent"]) for r in report} == {(0, 0, None)}
    assert Q.dq_counts(df).first().asDict() == {"total_rows": 0, "bad_rows": 0, "good_rows": 0}


def test_schema_without_differences(spark):
    assert Q.validate_schema(frame(spark), T.StructType.fromDDL("id int, mail string, n string")).count() == 0


def test_pair_not_in_keeps_nulls(spark):
    df = spark.createDataFrame([("P", "C"), ("P", None), (None, None), ("X", "C")], "a string, b string")
    assert C.pair_not_in(df, "a", "b", [("P", "C")]).count() == 3


def test_prefix_is_not_a_character_set(spark):
    df = spark.createDataFrame([(1, 2)], ["hr:review_date", "rhr"])
    assert C.strip_name_prefix(df, "hr:").columns == ["review_date", "rhr"]


@pytest.mark.parametrize("value, style, text", [
    ("1234567.8", "millions", "1.23m"), ("-0.0125", "percent_change", "(1.3%)"), ("0.0125", "points_change", "1.3%p"), ("-3.456", "pounds_change", "(£3.46)"), (None, "pounds", "£0.00")])
def test_kpi_text(spark, value, style, text):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(E.format_kpi(F.col("v"), style)).first()[0] == text


def test_financial_weeks_wrap_at_the_year(spark):
    cal = K.calendar_dimension(K.date_bounds(spark, "2022-08-01", "2024-12-31"), as_of="2024-01-01 00:00:00")
    first = cal.where("financial_week_number = 1").orderBy("date_value").first()["date_value"]
    week = K.previous_fin_week(cal, as_of=str(first)).first()
    assert week["fin_week"] in (52, 53)
    span = K.week_date_range(cal, K.previous_fin_week(cal, as_of=str(first))).first()
    assert (first - span["week_end"]).days == 1 and (span["week_end"] - span["week_start"]).days == 6
    per_year = cal.groupBy("financial_year").agg(F.max("financial_week_number").alias("w")).collect()
    assert all(r["w"] <= 53 for r in per_year)


def test_load_mode_predicate_reaches_the_scan(spark, sf):
    cond = K.load_mode_filter("o_orderdate", mode="H", date_from="1999-01-05", date_to="1999-02-10")
    plan = spark.read.parquet(f"{sf}/orders.parquet").where(cond)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_recipe_rejects_unknown_steps_and_reports_counts(spark):
    with pytest.raises(ValueError):
        run_recipe(spark, [{"card_type": "apply_magic"}], {})
    out = run_recipe(spark, [{"card_type": "apply_filter", "input_table": "r_in", "output_table": "r_out", "filter": ["id > 1"]}], {"r_in": spark.range(5)}, filter_condition="id < 4")
    assert out["r_out"].count() == 2 and out["run_summary"].count() == 0


def test_recipe_steps_on_small_frames(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 5), ("a", "2024-01-03", None), ("a", "2024-02-01", -2), ("b", "2024-01-01", 7)], "k string, d string, v int")
    steps = [
        {"card_type": "impute_null_rows_group", "input_table": "t0", "output_table": "t1", "partition_column_list": "k", "order_by_column": "d", "calculation_column_name": "v", "ytd_column_name": "filled"},
        {"card_type": "in_out_running_count", "input_table": "t1", "output_table": "t2", "order_by_column": "d", "value_column": "v", "column_name_in_count": "n_in", "column_name_out_count": "n_out"},
        {"card_type": "apply_pivot", "select_sql": "select k, substring(d, 1, 7) as m, v from t0", "group_by_columns": "k", "pivot_column": "m", "values": ["2024-01", "2024-02"], "aggregate_in": "sum(v)", "output_table": "p", "order_by": "k desc"},
        {"card_type": "apply_difference", "minuend": "t0", "subtrahend": "t0", "output_table": "none"},
        {"card_type": "apply_intersect", "input_tables": "t0,t0", "output_table": "same"},
        {"card_type": "apply_standardization_rule", "input_table": "t0", "output_table": "up", "standardization_rule": {"upper": "k"}},
        {"card_type": "apply_sparksql_2_tmp", "query": "select count(*) as n from up where k = 'A'", "table_name": "c"},
    ]
    out = run_recipe(spark, steps, {"t0": df})
    assert [r["filled"] for r in out["t1"].where("k = 'a'").orderBy("d").collect()] == [5, 5, -2]
    last = out["t2"].orderBy(F.col("n_in").desc(), F.col("n_out").desc()).first()
    assert (last["n_in"], last["n_out"]) == (2, 1)
    assert [tuple(r) for r in out["p"].collect()] == [("b", 7, None), ("a", 5, -2)]
    assert out["none"].count() == 0 and out["same"].count() == 4 and out["c"].first()["n"] == 3
