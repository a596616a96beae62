"""Slowly changing dimensions keep their invariants over several loads."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.operators import joins as J
from lakeops.operators import loads as D
from lakeops.session import fresh_path
from lakeops.sources import sinks as O

SCHEMA = "k int, a string, b int, ts int"


def versions(spark):
    one = spark.createDataFrame([(1, "x", 1, 1), (2, "y", None, 1), (3, "z", 3, 1)], SCHEMA)
    two = spark.createDataFrame([(1, "x", 1, 2), (2, "y", 5, 2), (4, "new", 4, 2), (4, "older", 4, 1)], SCHEMA)
    three = spark.createDataFrame([(2, "y", None, 3), (3, "late", 9, 0)], SCHEMA)
    return one, two, three


def load(spark, order_col="ts"):
    one, two, three = versions(spark)
    dim = D.new_dimension(one, as_of="2024-01-01 00:00:00")
    for src, as_of in ((two, "2024-02-01 00:00:00"), (three, "2024-03-01 00:00:00")):
        changed = D.scd2_changed_rows(D.one_per_key(src, ["k"], "ts"), dim, cols=["k", "a", "b"])
        dim = D.scd2_upsert(changed, dim, keys=["k"], cols=["a", "b", "ts"], as_of=as_of, order_col=order_col)
    return dim


def test_one_active_row_per_key_and_no_gaps(spark):
    rows = load(spark).collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r["k"], []).append(r)
    assert {k: sum(r["scd_active_flag"] == "Y" for r in v) for k, v in by_key.items()} == {1: 1, 2: 1, 3: 1, 4: 1}
    for v in by_key.values():
        v.sort(key=lambda r: r["record_start_date"])
        for before, after in zip(v, v[1:]):
            assert before["record_end_date"] == after["record_start_date"]
    assert len(by_key[2]) == 3 and len(by_key[1]) == 1
    assert by_key[4][0]["a"] == "new"


def test_source_older_than_the_active_row_changes_nothing(spark):
    three = [r for r in load(spark).collect() if r["k"] == 3]
    assert len(three) == 1 and three[0]["a"] == "z"


def test_minus_one_day_leaves_the_parity_gap(spark):
    one, two, _ = versions(spark)
    dim = D.new_dimension(one, as_of="2024-01-01 00:00:00")
    out = D.scd2_upsert(two.where("k = 2"), dim, keys=["k"], cols=["a", "b", "ts"], as_of="2024-02-01 00:00:00", end_mode="minus_1_day")
    assert out.where("k = 2 and scd_active_flag = 'N'").first()["record_end_date"] == datetime(2024, 1, 31)


def test_deleted_key_is_closed_without_successor(spark):
    one, _, _ = versions(spark)
    dim = D.new_dimension(one, as_of="2024-01-01 00:00:00")
    src = one.where("k = 1").withColumn("a", F.lit("D"))
    out = D.scd2_upsert(src, dim, keys=["k"], cols=["a", "b", "ts"], as_of="2024-02-01 00:00:00", delete_flag=("a", "D"))
    assert [r["scd_active_flag"] for r in out.where("k = 1").collect()] == ["N"]


def test_scd1_ignores_older_rows_and_resolves_duplicates(spark):
    one, two, three = versions(spark)
    tgt = one.withColumns({"create_datetime": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "update_datetime": F.lit(None).cast("timestamp_ntz")})
    out = D.scd1_upsert(two.unionByName(three.where("k = 3")), tgt, keys=["k"], update_cols=["a", "b", "ts"], as_of="2024-02-01 00:00:00", order_col="ts")
    assert sorted((r["k"], r["a"], r["b"]) for r in out.collect()) == [(1, "x", 1), (2, "y", 5), (3, "z", 3), (4, "new", 4)]


def test_scd2_folder_rerun_is_idempotent_and_keeps_history_files(spark):
    path = fresh_path(spark, "t_scd2")
    one, two, _ = versions(spark)
    D.scd2_folder(one, path, keys=["k"], compare=["a", "b"], as_of="2024-01-01 00:00:00")
    first = sorted(map(str, D.scd2_folder(two, path, keys=["k"], compare=["a", "b"], as_of="2024-02-01 00:00:00", order_col="ts").collect()))
    again = sorted(map(str, D.scd2_folder(two, path, keys=["k"], compare=["a", "b"], as_of="2024-03-01 00:00:00", order_col="ts").collect()))
    assert first == again


def test_validity_boundaries(spark):
    fact = spark.createDataFrame([(1, "2024-01-10")], "k int, d string").withColumn("d", F.to_date("d"))
    dim = spark.createDataFrame([(1, "2024-01-01", "2024-01-10", "old"), (1, "2024-01-10", "9999-12-31", "new")], "k int, s string, e string, v string")
    dim = dim.withColumns({"s": F.to_date("s"), "e": F.to_date("e")})
    half = J.join_validity_half_open(fact, dim, on=["k"], date="d", start="s", end="e").collect()
    closed = J.join_validity_closed(fact, dim, on=["k"], date="d", start="s", end="e").collect()
    assert [r["v"] for r in half] == ["new"] and sorted(r["v"] for r in closed) == ["new", "old"]


def test_not_in_with_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    listed = lambda *v: spark.createDataFrame([(i,) for i in v], "x int")
    values = lambda df: sorted((r["x"] for r in df.collect()), key=str)
    assert values(J.anti_join_not_in(left, listed(1), "x")) == [2]
    assert values(J.anti_join_not_in(left, listed(1, None), "x")) == []
    assert values(J.anti_join_not_in(left, listed(), "x")) == [1, 2, None]


def test_a_key_that_changes_partition_leaves_the_old_one(spark):
    path = fresh_path(spark, "t_moved")
    src = lambda *rows: spark.createDataFrame(rows, "k int, a string, p string")
    D.scd1_folder(src((1, "x", "A"), (2, "y", "A"), (3, "z", "C"), (5, "v", None)), path, keys=["k"], as_of="2024-01-01 00:00:00", partition_keys=["p"])
    out = D.scd1_folder(src((1, "x2", "B"), (3, "z", "B"), (5, "v2", "A")), path, keys=["k"], as_of="2024-02-01 00:00:00", partition_keys=["p"])
    assert sorted((r.k, r.a, r.p) for r in out.collect()) == [(1, "x2", "B"), (2, "y", "A"), (3, "z", "B"), (5, "v2", "A")]


def test_two_loads_with_one_time_keep_both_histories(spark):
    path = fresh_path(spark, "t_same_time")
    src = lambda *rows: spark.createDataFrame(rows, "k int, a string")
    load = lambda df, at: D.scd2_folder(df, path, keys=["k"], compare=["a"], as_of=at)
    load(src((1, "x"), (2, "y")), "2024-01-01 00:00:00")
    load(src((1, "x2")), "2024-02-01 00:00:00")
    load(src((2, "y2")), "2024-02-01 00:00:00")
    out = load(src((2, "y2")), "2024-02-01 00:00:00")
    assert sorted((r.k, r.a, r.scd_active_flag) for r in out.collect()) == [(1, "x", "N"), (1, "x2", "Y"), (2, "y", "N"), (2, "y2", "Y")]


def test_scd1_folder_survives_a_crash_between_its_writes(spark, monkeypatch):
    path = fresh_path(spark, "t_scd1_crash")
    one = spark.createDataFrame([(1, "x", "a"), (2, "y", "a"), (3, "z", "c")], "k int, v string, p string")
    D.scd1_folder(one, path, keys=["k"], as_of="2024-01-01 00:00:00", partition_keys=["p"])
    two = spark.createDataFrame([(1, "x2", "b"), (3, "z2", "b")], "k int, v string, p string")

    def stop(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(D, "drop_partition_folders", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            D.scd1_folder(two, path, keys=["k"], as_of="2024-02-01 00:00:00", partition_keys=["p"])
    for _ in range(2):
        out = D.scd1_folder(two, path, keys=["k"], as_of="2024-02-01 00:00:00", partition_keys=["p"])
        assert sorted((r.k, r.v, r.p) for r in out.collect()) == [(1, "x2", "b"), (2, "y", "a"), (3, "z2", "b")]
    # A later delivery of other values after such a crash as well.
    with monkeypatch.context() as m:
        m.setattr(D, "drop_partition_folders", stop)
        with pytest.raises(RuntimeError):
            D.scd1_folder(spark.createDataFrame([(2, "y3", "d")], "k int, v string, p string"), path, keys=["k"], as_of="2024-03-01 00:00:00", partition_keys=["p"])
    out = D.scd1_folder(spark.createDataFrame([(2, "y4", "e")], "k int, v string, p string"), path, keys=["k"], as_of="2024-04-01 00:00:00", partition_keys=["p"])
    assert sorted((r.k, r.v, r.p) for r in out.collect()) == [(1, "x2", "b"), (2, "y4", "e"), (3, "z2", "b")]


def test_partition_rewrites_survive_a_crash(spark, monkeypatch):
    def stop(*args):
        raise RuntimeError("stopped")

    path = fresh_path(spark, "t_rewrite_crash")
    spark.range(40).selectExpr("id", "cast(id % 4 as int) as p").write.partitionBy("p").parquet(path)
    fresh = spark.range(100, 104).selectExpr("id", "2 as p")
    with monkeypatch.context() as m:
        m.setattr(O, "drop_partition_folders", stop)
        with pytest.raises(RuntimeError):
            O.replace_recent_partitions(fresh, path, key="p", cutoff=2)
    out = O.replace_recent_partitions(fresh, path, key="p", cutoff=2)
    assert sorted(r.id for r in out.collect()) == sorted([i for i in range(40) if i % 4 < 2] + list(range(100, 104)))
    with monkeypatch.context() as m:
        m.setattr(O, "drop_partition_folders", stop)
        with pytest.raises(RuntimeError):
            O.delete_where_from(spark, path, key="p", where="p = 1 or id < 9")
    out = O.delete_where_from(spark, path, key="p", where="p = 1 or id < 9")
    assert sorted(r.id for r in out.collect()) == sorted([i for i in range(9, 40) if i % 4 == 0] + list(range(100, 104)))
