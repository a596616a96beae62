"""Recipes by dependency, their ledger, and the layout of written files."""

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeops.plans import recipe as P
from lakeops.plans.recipe_order import RecipeError, fingerprints, levels
from lakeops.session import fresh_path
from lakeops.sources import sinks
from lakeops.sources.layout import by_layout

STEPS = [
    {"card_type": "apply_filter", "input_table": "t_in", "output_table": "t_some", "filter": ["id < 8"]},
    {"card_type": "apply_sparksql_4m_tmp", "query": "select id, id % 2 as p from t_some where 'from t_last' <> ''", "table_name": "t_parts"},
    {"card_type": "apply_group_by", "input_table": "t_parts", "output_table": "t_sums", "group_by_columns": "p", "aggregate_conditions": ["sum(id) as s"]},
    {"card_type": "apply_join", "left_table_name": "t_parts", "right_table_name": "t_sums", "temp_table_name": "t_last", "join_type": "inner", "on_sql_condition": "l.p = r.p", "select_sql": ["l.id", "r.s"]},
]


def test_levels_follow_what_steps_read():
    assert levels(STEPS, ["t_in"]) == [[0], [1], [2], [3]]
    assert levels(STEPS[::-1], ["t_in"]) == [[3], [2], [1], [0]]
    two = [{"card_type": "read_delta", "data_path": "x/", "output_table": "a"}, {"card_type": "clean_delta", "data_path": "x"},
           {"card_type": "write_delta", "data_path": "x", "query": "select 1", "label": "w"}, {"card_type": "apply_sparksql_4m_tmp", "query": "select 2", "table_name": "b", "depends_on": "w"}]
    assert levels(two) == [[2], [1, 3], [0]]


@pytest.mark.parametrize("steps, given, words", [
    (STEPS, [], ["t_in", "no step"]),
    ([*STEPS, STEPS[0]], ["t_in"], ["t_some", "made by"]),
    ([{**STEPS[0], "input_table": "t_last", "card_id": "first"}, *STEPS[1:]], [], ["cycle", "first", "step 2", "step 4"]),
    ([{**STEPS[0], "depends_on": ["nobody"]}], ["t_in"], ["nobody"]),
    ([{"card_type": "table_lookup", "source_table": "t_in", "cache_table": "t_in"}], ["t_in"], ["output_table"]),
])
def test_orders_that_do_not_exist_name_their_steps(steps, given, words):
    with pytest.raises(RecipeError) as e:
        levels(steps, given)
    assert all(w in str(e.value) for w in words)


def test_a_shuffled_recipe_gives_the_same(spark):
    frames = {"t_in": spark.range(20)}
    want = sorted(map(tuple, P.run_recipe(spark, STEPS, frames)["t_last"].collect()))
    for seed in range(4):
        steps = random.Random(seed).sample(STEPS, len(STEPS))
        assert sorted(map(tuple, P.run_recipe(spark, steps, frames, by_dependency=True)["t_last"].collect())) == want
    with pytest.raises(Exception):
        P.run_recipe(spark, STEPS[::-1], frames)


def test_steps_of_a_level_end_before_an_error_is_raised(spark):
    path = fresh_path(spark, "t_level")
    steps = [{"card_type": "apply_sparksql_2_tmp", "query": "select assert_true(id < 0) from t_in", "table_name": "t_bad"},
             {"card_type": "write_delta", "query": "select * from t_in", "data_path": path, "label": "w"}]
    with pytest.raises(Exception, match="assert|USER_RAISED"):
        P.run_recipe(spark, steps, {"t_in": spark.range(9)}, by_dependency=True)
    assert spark.read.parquet(path).count() == 9


def writes(base, fail):
    return [
        {"card_type": "write_delta", "query": "select id, id % 3 as p from t_in", "data_path": f"{base}/first", "label": "first"},
        {"card_type": "write_dataset", "query": "select id, id % 3 as p from t_in", "data_path": f"{base}/appended", "partition_key_columns": "p", "label": "second"},
        {"card_type": "apply_sparksql_2_tmp", "query": f"select assert_true({'false' if fail else 'true'}) as ok from t_in", "table_name": "t_checked", "card_id": "check"},
        {"card_type": "write_dataset", "query": "select id from t_in cross join (select count(ok) as n from t_checked)", "data_path": f"{base}/appended_plain", "label": "third"},
    ]


def files(path):
    return sorted((str(p.relative_to(path)), p.stat().st_mtime_ns) for p in Path(path).rglob("part-*"))


def test_a_failed_recipe_goes_on_where_it_stopped(spark, monkeypatch):
    base = fresh_path(spark, "t_ledger")
    frames, options = {"t_in": spark.range(9)}, {"ledger": f"{base}/ledger", "versions": {"t_in": "v1"}}
    fail = {"on": True}

    def step(run, s):
        if fail["on"]:
            raise RuntimeError("stopped")
        run.put(s["table_name"], run.spark.sql(s["query"]))

    monkeypatch.setitem(P.STEPS, "apply_sparksql_2_tmp", step)
    for _ in range(2):
        with pytest.raises(RuntimeError, match="stopped"):
            P.run_recipe(spark, writes(base, False), frames, **options)
    before = files(f"{base}/first"), files(f"{base}/appended")
    fail["on"] = False
    for _ in range(2):
        out = P.run_recipe(spark, writes(base, False), frames, **options)
        assert [tuple(r) for r in out["run_summary"].collect()] == [("first", "written", 9), ("second", "written", 9), ("third", "written", 9)]
    assert (files(f"{base}/first"), files(f"{base}/appended")) == before
    assert spark.read.parquet(f"{base}/appended").count() == spark.read.parquet(f"{base}/appended_plain").count() == 9
    # New input, new writes: an overwrite replaces, an append adds.
    P.run_recipe(spark, writes(base, False), frames, ledger=f"{base}/ledger", versions={"t_in": "v2"})
    assert spark.read.parquet(f"{base}/first").count() == 9 and spark.read.parquet(f"{base}/appended").count() == 18


def test_an_append_that_dies_between_two_moves_adds_no_row_twice(spark):
    base = fresh_path(spark, "t_once")
    df = spark.range(40).withColumn("p", F.col("id") % 4)
    sinks.append_once(df, f"{base}/t", keys=["p"], staged=f"{base}/s0", tag="old")
    parts = df.repartition(2).write.partitionBy("p")
    parts.parquet(f"{base}/s1")
    # As if the run had died after the first move: one file is in the table, the others are staged.
    one = next(Path(f"{base}/s1").rglob("part-*"))
    target = Path(f"{base}/t") / one.parent.name / f"part-new-{one.name[5:]}"
    target.write_bytes(one.read_bytes())
    one.unlink()
    for _ in range(2):
        out = sinks.append_once(df, f"{base}/t", keys=["p"], staged=f"{base}/s1", tag="new")
        assert sorted(r[0] for r in out.groupBy("id").count().select("count").collect()) == [2] * 40


def test_fingerprints_follow_steps_and_inputs():
    one = fingerprints(STEPS, {"t_in": "v1"})
    assert one == fingerprints(STEPS, {"t_in": "v1"}) and len(set(one)) == 4
    assert not set(one) & set(fingerprints(STEPS, {"t_in": "v2"}))
    changed = fingerprints([*STEPS[:2], {**STEPS[2], "aggregate_conditions": ["max(id) as s"]}, STEPS[3]], {"t_in": "v1"})
    assert [a == b for a, b in zip(one, changed)] == [True, True, False, False]


def test_layout_lets_filters_on_either_column_skip_row_groups(spark):
    path = fresh_path(spark, "t_layout")
    n = 40_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("a"), F.concat(F.lit("k"), F.lpad((F.col("id") * 104729 % n).cast("string"), 6, "0")).alias("b"), F.when(F.col("id") % 50 > 0, F.col("id")).alias("c"))
    laid = by_layout(df, ["a", "b"])
    laid.write.option("parquet.block.size", 16_384).option("parquet.page.row.count.limit", 500).option("parquet.block.row.count.limit", 1000).parquet(path)
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    groups = [pq.ParquetFile(f).metadata.row_group(g) for f in Path(path).glob("part-*") for g in range(pq.ParquetFile(f).num_row_groups)]
    assert len(groups) >= 8
    for k, point in ((0, n // 3), (1, f"k{n // 3:06d}")):
        stats = [g.column(k).statistics for g in groups]
        met = sum(s.min <= point <= s.max for s in stats)
        assert met <= 0.6 * len(groups), (k, met, len(groups))


def test_layout_of_other_types_nulls_and_no_rows(spark):
    df = spark.range(100).selectExpr("cast(id % 2 as boolean) as f", "date_add(date'2020-01-01', cast(id as int)) as d", "timestamp'2020-01-01 00:00:00' as t", "if(id % 3 = 0, null, cast(id as decimal(9,2))) as m")
    assert by_layout(df, ["f", "d", "t", "m"]).exceptAll(df).isEmpty() and by_layout(df, ["m"]).count() == 100
    assert by_layout(df.where("false"), ["d"]).count() == 0
    with pytest.raises(ValueError):
        by_layout(df, [])


def test_storage_steps_on_partitions_that_empty(spark):
    base = fresh_path(spark, "t_storage")
    df = spark.range(30).selectExpr("id", "cast(id % 3 as int) as p")
    steps = [{"card_type": "write_delta", "query": "select * from t_rows", "data_path": base, "partition_key_columns": "p"},
             {"card_type": "delete_delta", "data_path": base, "partition_key": "p", "query": "p = 1 or id = 2"},
             {"card_type": "clean_delta", "data_path": base, "partition_key": "p", "cutoff": 1},
             {"card_type": "read_delta", "data_path": base, "output_table": "t_left"}]
    for by_dependency in (False, True):
        out = P.run_recipe(spark, steps, {"t_rows": df}, by_dependency=by_dependency)
        assert sorted(r.id for r in out["t_left"].collect()) == [i for i in range(30) if i % 3 == 2 and i != 2]
        assert sorted(p.name for p in Path(base).glob("p=*")) == ["p=2"]
    P.run_recipe(spark, [{"card_type": "delete_delta", "data_path": base, "partition_key": "p", "query": "true"}], {})
    assert not list(Path(base).glob("p=*"))
