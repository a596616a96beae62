"""A drained stream does not see a file twice, and a batch can be written again."""

from pyspark.sql import functions as F

from lakeops.session import fresh_path
from lakeops.streaming import changes as C

ENTITIES = {"item": "id string, name string"}


def body(spark, *messages):
    return spark.createDataFrame([(bytearray(m, "utf-8"),) for m in messages], "body binary")


MESSAGE = '{"message": {"item": {"id": "%s", "name": "n"}, "headers": {"operation": "%s", "changeSequence": "%s", "timestamp": "%s"}}}'


def test_rerun_adds_nothing(spark):
    src, out, state = (fresh_path(spark, n) for n in ("t_in", "t_out", "t_state"))
    same = MESSAGE % ("1", "INSERT", "01", "")
    body(spark, same, same, MESSAGE % ("2", "DELETE", "02", "2024-01-01T00:00:00.000"), "not json").coalesce(1).write.parquet(src)

    def run():
        sdf = C.stream_file_source(spark, src, schema="body binary", fmt="parquet")
        C.stream_for_each_batch(sdf, C.land_entities(ENTITIES, out), checkpoint=state).awaitTermination()
        return spark.read.parquet(f"{out}/item/batch=*").count()

    assert run() == 2
    assert run() == 2
    body(spark, MESSAGE % ("3", "INSERT", "03", "")).coalesce(1).write.mode("append").parquet(src)
    assert run() == 3


def test_a_batch_written_twice_counts_once(spark):
    out = fresh_path(spark, "t_twice")
    land = C.land_entities(ENTITIES, out)
    batch = body(spark, MESSAGE % ("1", "INSERT", "01", ""))
    land(batch, 4)
    land(batch, 4)
    rows = spark.read.parquet(f"{out}/item/batch=*").collect()
    assert len(rows) == 1 and rows[0]["extraction_time"] == C.NO_TIME


def test_absent_entities_are_reported(spark):
    parsed = body(spark, MESSAGE % ("1", "INSERT", "01", "")).select(F.from_json(F.col("body").cast("string"), C.envelope_schema(ENTITIES)).alias("e")).select("e.*")
    frames, absent = C.cdc_route_entities(parsed, ["item", "order"])
    assert list(frames) == ["item"] and absent == ["order"]


def test_latest_state_drops_deleted_keys(spark):
    df = spark.createDataFrame([(1, 1, "INSERT", "a"), (1, 2, "UPDATE", "b"), (2, 1, "INSERT", "c"), (2, 3, "delete", "c")], "k int, s int, op string, v string")
    out = C.cdc_latest_state(df, keys=["k"], sequence="s", operation="op").collect()
    assert [(r["k"], r["v"]) for r in out] == [(1, "b")]


def test_a_rate_limited_feed_takes_six_batches(spark, tmp_path):
    import __spark_entry__

    rows = spark.range(600).selectExpr("id as event_id", "id % 7 as user_id", "'click' as event_type", "timestamp_ntz '2024-01-01 00:00:00' as ts")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    out = __spark_entry__.queries()["stream_rate_limit"](spark, str(tmp_path)).collect()
    assert sorted(r["event_id"] for r in out) == list(range(600))
    assert {r["batches"] for r in out} == {6}
