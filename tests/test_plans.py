"""Plans and sources stay free of what does not scale."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry

PACKAGE = Path(__file__).resolve().parents[1] / "lakeops"
SAMPLE = ["fact_owings_weekly", "fact_script_funnel", "fact_clinical_checks", "fact_dispensed_detail", "fact_at_risk", "mart_performance", "mart_bulk_buyers",
          "join_scalar_params", "cross_join_grid", "anti_join_not_in", "agg_rolling_periods", "scd2_upsert", "surrogate_key", "fill_forward_group", "dq_row_rules"]

# Places that bring a bounded number of values to the driver: partition values, newest file times.
COLLECTS = {"sources/sinks.py": 1}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SAMPLE)
def test_no_nested_loops_and_no_python(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "BatchEvalPython", "MapInPandas"):
        assert bad not in text


def test_scan_is_pruned_and_filtered(spark, sf):
    text = plan(entry.queries()["scan_table_pruned"](spark, sf))
    assert "PushedFilters" in text and "l_comment" not in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_orderkey", "l_extendedprice", "l_returnflag", "l_shipdate"}


def test_sources_do_not_pull_data_to_the_driver():
    found = []
    for path in PACKAGE.rglob("*.py"):
        rel = str(path.relative_to(PACKAGE))
        if rel.startswith("llm/"):
            continue
        text = path.read_text()
        found += [f"{bad} in {rel}" for bad in ("toPandas(", ".rdd", "localCheckpoint", "current_date", "current_timestamp", ".crossJoin(") if bad in text]
        found += [f"collect in {rel}"] if text.count(".collect()") > COLLECTS.get(rel, 0) else []
    assert not found


def test_the_point_of_sale_feed_is_made_and_stored_with_one_shuffle(spark, tmp_path, monkeypatch):
    from lakeops.plans import feeds
    from lakeops.registry import Tables

    spark.sql("""select id as o_orderkey, id % 7 as o_custkey, 'O' as o_orderstatus, 9.5D as o_totalprice, timestamp_ntz'2001-02-03' as o_orderdate, '5-LOW' as o_orderpriority
              from (select explode(array(4L, 4L, 9L, null)) as id)""").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("""select k as l_orderkey, 3L as l_partkey, 5L as l_suppkey, n as l_linenumber, 1D as l_quantity, p as l_extendedprice, 0.01D as l_discount, 0D as l_tax,
              'N' as l_returnflag, 'O' as l_linestatus, timestamp_ntz'2001-02-03' as l_shipdate from values (4L, 1, 2D), (4L, 1, 1D), (4L, 2, 3D), (9L, 1, 4D) as t(k, n, p)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    plans = []
    made = feeds.framed
    monkeypatch.setattr(feeds, "framed", lambda lines, *a: (plans.append(plan(lines)), made(lines, *a))[1])
    path = feeds.write_pos(Tables(spark, str(tmp_path)))
    assert len(plans) == 1 and plans[0].count("Exchange ") == 1
    assert list(Path(path).glob("part-*")) and all(p.suffix == ".gz" for p in Path(path).glob("part-*"))
    pos = feeds.read_pos(spark, path)
    kinds = {r["recordtype"]: r["count"] for r in pos.where("TRANSACTIONID is not null").groupBy("recordtype").count().collect()}
    assert kinds["H"] == kinds["TR"] == 4 and kinds["L"] == 3
    assert {r.Attribute8 for r in pos.where("recordtype = 'L' and TRANSACTIONID is not null").collect()} == {"1.00", "3.00", "4.00"}


def test_the_point_of_sale_feed_has_code_that_the_jvm_compiles(spark, tmp_path, monkeypatch, capsys):
    """Methods of more than 8,000 bytes stay interpreted, and so does a row generator over a function with a lambda."""
    from lakeops.plans import feeds
    from lakeops.registry import Tables

    spark.sql("select id as o_orderkey, id % 7 as o_custkey, 'O' as o_orderstatus, 9.5D as o_totalprice, timestamp_ntz'2001-02-03' as o_orderdate, '5-LOW' as o_orderpriority from range(5)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("""select id as l_orderkey, 3L as l_partkey, 5L as l_suppkey, 1 as l_linenumber, 1D as l_quantity, 2D as l_extendedprice, 0.01D as l_discount, 0D as l_tax,
              'N' as l_returnflag, 'O' as l_linestatus, timestamp_ntz'2001-02-03' as l_shipdate from range(5)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    code = {}

    def explained(df, name):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            df.explain("codegen")
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        code[name] = capsys.readouterr().out
        return df

    made, keyed = feeds.framed, feeds.propagate_parent_keys
    monkeypatch.setattr(feeds, "framed", lambda lines, *a: made(explained(lines, "lines"), *a))
    monkeypatch.setattr(feeds, "propagate_parent_keys", lambda *a, **b: explained(keyed(*a, **b), "keys"))
    feeds.read_pos(spark, feeds.write_pos(Tables(spark, str(tmp_path))))
    assert re.search(r"\*\(\d+\) Generate explode", code["lines"])
    sizes = {name: [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)] for name, text in code.items()}
    assert sizes["lines"] and sizes["keys"] and max(sizes["lines"] + sizes["keys"]) < 7000
