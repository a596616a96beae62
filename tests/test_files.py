"""Feeds with awkward files, and the sizes of what is written."""

import datetime
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeops.session import fresh_path
from lakeops.sources import files as R
from lakeops.sources import sinks as W

SCHEMA = R.text_schema([" a", "b", "c "])


def put(folder, name, lines):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text("".join(f"{x}\n" for x in lines))


def local(spark, name):
    return fresh_path(spark, name).removeprefix("file:")


def test_header_and_trailer_per_file(spark):
    path = local(spark, "t_feed")
    put(path, "one.psv", ["H|x|y", "1|p|q", "2|p|q", "T|2|"])
    put(path, "two.psv", ["H|x|y", "3|p", "T|1|"])
    put(path, "empty.psv", [])
    both = R.drop_header_trailer(spark, path, schema=SCHEMA, trailer=True)
    assert sorted((r["a"], r["c"]) for r in both.collect()) == [("1", "q"), ("2", "q"), ("3", None)]
    header = R.drop_header_trailer(spark, path, schema=SCHEMA)
    assert header.count() == 5 and header.columns == ["a", "b", "c"]


def test_trailer_when_a_file_is_split(spark):
    path = local(spark, "t_split")
    put(path, "big.psv", ["H|x|y", *[f"{i}|{'p' * 50}|q" for i in range(5000)], "T|5000|"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = R.drop_header_trailer(spark, path, schema=SCHEMA, trailer=True)
        assert df.rdd.getNumPartitions() > 3
        assert df.count() == 5000 and df.where("a = 'T'").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024 * 1024))


def test_short_file_names_give_nulls(spark):
    path = local(spark, "t_names")
    put(path, "CUST_UK.psv", ["1|p|q"])
    put(path, "CUST_UK_7_20240131_101500.psv", ["2|p|q"])
    df = R.filename_timestamp(R.filename_columns(R.scan_delimited(spark, path, schema=SCHEMA), parts={2: "no"}), date_part=3, time_part=4, name="at")
    assert {r["a"]: (r["no"], r["at"]) for r in df.collect()} == {"1": (None, None), "2": ("7", "2024-01-31 10:15:00")}


def sizes(path, suffix):
    return [os.path.getsize(p) for p in Path(path).glob(f"part-*.{suffix}")]


def test_split_sizes(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("id"), F.repeat(F.lit("x"), (F.col("id") % 100).cast("int")).alias("pad"))
    by_rows, by_size = local(spark, "t_rows"), local(spark, "t_size")
    assert W.split_by_rows(df, by_rows, rows=1500).count() == 20000
    assert max(sum(1 for _ in p.open()) for p in Path(by_rows).glob("part-*.csv")) <= 1501
    assert W.split_by_size(df, by_size, max_bytes=50_000).count() == 20000
    assert max(sizes(by_size, "csv")) <= 50_000


def test_size_guard(spark):
    df = spark.range(5000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    one, many = local(spark, "t_one"), local(spark, "t_many")
    W.size_guarded_parquet(df, one)
    W.size_guarded_parquet(df, many, max_bytes=100_000)
    assert len(sizes(one, "parquet")) == 1 and len(sizes(many, "parquet")) >= 4


def test_replace_recent_partitions_can_run_again(spark):
    dest = local(spark, "t_recent")
    day = lambda s: datetime.date.fromisoformat(s)
    old = spark.createDataFrame([(1, day("2024-01-01")), (2, day("2024-01-02")), (3, day("2024-01-03"))], "v int, d date")
    new = spark.createDataFrame([(20, day("2024-01-02"))], "v int, d date")
    W.write_partitioned_append(old, dest, keys=["d"])
    for _ in range(2):
        out = W.replace_recent_partitions(new, dest, key="d", cutoff=day("2024-01-02"))
        assert sorted(r["v"] for r in out.collect()) == [1, 20]


def test_delete_where_touches_only_partitions_that_lose_rows(spark):
    dest = local(spark, "t_delete")
    df = spark.createDataFrame([(1, "a:b"), (2, "a:b"), (3, "c"), (None, "c"), (5, None)], "v int, p string")
    W.write_partitioned_append(df, dest, keys=["p"])
    before = {str(f): f.stat().st_mtime_ns for f in Path(dest).glob("p=c/part-*")}
    out = W.delete_where_from(spark, dest, key="p", where="v in (1, 2, 5)")
    assert sorted(str(r["v"]) for r in out.collect()) == ["3", "None"]
    assert {str(f): f.stat().st_mtime_ns for f in Path(dest).glob("p=c/part-*")} == before


def test_missing_partitions_give_an_empty_frame(spark):
    base = local(spark, "t_runs")
    W.write_run_folder(spark.range(3), base, run_date="20240101", run_time="000000")
    df = R.scan_parquet_partitions(spark, base, days=["20240101", "20240102"], schema="id bigint")
    assert df.count() == 3
    assert R.scan_parquet_partitions(spark, base, days=["20240105"], schema="id bigint").count() == 0
    bare = local(spark, "t_bare")
    Path(bare).mkdir(parents=True)
    assert R.scan_parquet_partitions(spark, bare, schema="id bigint").count() == 0
    with pytest.raises(FileNotFoundError):
        R.scan_parquet_partitions(spark, local(spark, "t_none"), schema="id bigint")


def test_delete_all_rows_keeps_columns(spark):
    dest = local(spark, "t_empty")
    W.append_to_table(spark.range(5), dest)
    out = W.delete_all_rows(spark, dest)
    assert out.count() == 0 and out.columns == ["id"] and spark.read.parquet(dest).columns == ["id"]


AWKWARD = [None, "", " ", "a,b|c", 'say "x"', "two\nlines", "r\rn\r\n", "  blanks  ", "\\ back", '"', "'", "é\tü"]


def awkward(spark):
    return spark.createDataFrame([(i, v, f"p{i % 3}") for i, v in enumerate(AWKWARD * 5)], "i int, v string, p string").repartition(4)


@pytest.mark.parametrize("sink", ["run", "partitioned", "rows", "size", "compact"])
def test_csv_sinks_read_back_what_they_wrote(spark, sink):
    df, dest = awkward(spark), fresh_path(spark, "t_csv")
    if sink == "run":
        out = W.write_run_folder(df, dest, run_date="20240101", run_time="000000", fmt="csv")
    elif sink == "partitioned":
        out = W.write_partitioned_append(df, dest, keys=["p"], fmt="csv")
    elif sink == "rows":
        out = W.split_by_rows(df, dest, rows=4)
    elif sink == "size":
        out = W.split_by_size(df, dest, max_bytes=200)
    else:
        # The small files themselves have no text for null, so the texts that look like one are left out.
        df = df.where("v is not null and v <> ''")
        df.write.csv(fresh := fresh_path(spark, "t_small"), sep="|", header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        out = W.compact_small_files(spark, fresh, dest, target_bytes=300, schema=df.schema, escape='"')
    assert sorted(map(str, out.select("i", "v", "p").collect())) == sorted(map(str, df.collect()))


def test_a_wide_row_does_not_change_the_number_of_files(spark):
    df = spark.range(200).select(F.col("id"), F.when(F.col("id") == 7, F.repeat(F.lit("x"), 200_000)).otherwise("y").alias("pad"))
    dest = local(spark, "t_wide")
    assert W.split_by_size(df, dest, max_bytes=100_000).count() == 200
    assert len(sizes(dest, "csv")) <= 3


def test_no_outputs_give_an_empty_list(spark):
    assert W.write_nonempty_csv({}, fresh_path(spark, "t_none"), run_date="20240101", run_time="000000").count() == 0


def test_a_snapshot_of_several_files_is_read_whole(spark):
    base = local(spark, "t_snapshots")
    for i in (1, 2, 3):
        spark.range(100 * i).select("id", F.lit(i).alias("version")).repartition(4).write.parquet(f"{base}/v{i}")
        for f in Path(f"{base}/v{i}").iterdir():
            os.utime(f, (1_700_000_000 + 1000 * i + hash(f.name) % 10,) * 2)
    latest = R.scan_latest_file(spark, base, fmt="parquet", schema="id bigint, version int")
    assert latest.count() == 300 and {r.version for r in latest.collect()} == {3}
    two = R.scan_latest_two_files(spark, base, fmt="parquet", schema="id bigint, version int").groupBy("version", "snapshot").count().collect()
    assert {(r.version, r.snapshot, r["count"]) for r in two} == {(3, 1, 300), (2, 2, 200)}
    assert R.scan_latest_file(spark, str(Path(base).parent / Path(base).name / "v1"), fmt="parquet", schema="id bigint, version int").count() < 100


def test_a_guarded_file_is_written_without_a_shuffle_and_large_frames_in_task_shares(spark, monkeypatch):
    df = spark.range(0, 5000, 1, 6).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    dealt = []
    monkeypatch.setattr(W, "_dealt", lambda stored, size, most: dealt.append(most) or stored.repartition(max(1, -(-size // int(most)))))
    monkeypatch.setattr(W, "PART_BYTES", 50_000)
    one, many = local(spark, "t_guard_one"), local(spark, "t_guard_many")
    assert W.size_guarded_parquet(df, one).count() == 5000
    assert dealt == [] and len(sizes(one, "parquet")) == 1
    assert W.size_guarded_parquet(df, many, max_bytes=200_000).count() == 5000
    assert dealt == [50_000] and len(sizes(many, "parquet")) >= 6


def test_xml_files_hold_a_bounded_number_of_documents(spark, tmp_path, monkeypatch):
    from lakeops.plans import files as P
    from lakeops.registry import Tables

    monkeypatch.setattr(P, "XML_FILE_ROWS", 100)
    path = P.write_xml(spark.range(950).coalesce(1).selectExpr("cast(id as string) as k"), Tables(spark, str(tmp_path)), "row", "rows")
    files = list(Path(path.removeprefix("file:")).glob("part-*"))
    assert len(files) == 10
    assert R.scan_xml_rows(spark, path, row_tag="row", schema="k string").distinct().count() == 950


@pytest.mark.parametrize("value", ["concat('x', id)", "if(id = 1, null, concat('x', id))"])
def test_first_and_last_lines_around_values_with_and_without_nulls(spark, value):
    from lakeops.plans.files import framed

    lines = spark.range(3).coalesce(1).selectExpr(f"{value} as text")
    assert [r["value"] for r in framed(lines, "head", "tail").collect()] == ["head", "x0", "x1" if value.startswith("concat") else None, "x2", "tail"]
