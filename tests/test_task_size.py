"""The queries bound what one task gets, whatever the session they run in merges or reads at once."""

from pyspark.sql import functions as F

from lakeops.registry import Tables
from lakeops.session import tune


def tasks(df):
    return len(df.withColumn("_task", F.spark_partition_id()).groupBy("_task").agg(F.max("h")).collect())


def test_a_shuffle_is_not_merged_into_large_partitions(spark):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    kept = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        tune(spark)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(8 * 1024 * 1024)
        wide = spark.range(0, 600_000, 1, 8).select((F.col("id") % 50_021).alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("h"))
        assert tasks(wide.repartition("k")) >= 4
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        tune(spark)


def test_a_scan_reads_small_splits(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256m")
    tune(spark)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(16 * 1024 * 1024)


def test_newest_snapshots_of_few_keys_do_not_shuffle_the_rows(spark):
    from lakeops.operators import joins as J

    rows = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 3 = 0, 'a', 'b') as c", "cast(id % 4 as int) as run", "id", "cast(id as string) as h")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = J.join_latest_snapshot(rows, rows.where("run <> 3").select("c", "run"), key=["c"], by="run", few_keys=True)
        assert tasks(out) == 8 and out.where("run <> 2").isEmpty() and out.count() == 10_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_shuffles_start_from_more_partitions_on_larger_tables(spark, tmp_path, monkeypatch):
    from lakeops import session

    hashed = F.sha2(F.col("id").cast("string"), 512).alias("h")
    for name, n in (("small", 1_000), ("large", 100_000)):
        spark.range(n).select("id", hashed).write.parquet(f"{tmp_path}/{name}/rows.parquet")
    monkeypatch.setattr(session, "TABLE_BYTES_PER_PARTITION", 256 * 1024)
    monkeypatch.setitem(session.RUNTIME_SETTINGS, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(256 * 1024))
    started = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        wide = Tables(spark, f"{tmp_path}/large").rows
        assert tasks(wide.repartition("id")) > int(started)
        Tables(spark, f"{tmp_path}/small")
        assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None
        assert spark.conf.get("spark.sql.shuffle.partitions") == started
    finally:
        monkeypatch.undo()
        spark.conf.unset(session.INITIAL_PARTITIONS)
        tune(spark)
