"""File streams made from the events: envelopes are written as files and drained through Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.plans.relational import money
from lakeops.registry import Tables, query
from lakeops.session import fresh_path
from lakeops.streaming import changes as C

#: One entity per event type; refunds are known but never sent.
ENTITIES = {
    "click": "event_id string, user_id string, value string",
    "purchase": "event_id string, user_id string, value string, k string",
    "view": "event_id string, user_id string, k string",
    "signup": "event_id string, user_id string",
    "error": "event_id string, user_id string, value string, props string",
    "refund": "event_id string, reason string",
}
SENT = [name for name in ENTITIES if name != "refund"]
EVENT = "event_id bigint, user_id bigint, event_type string, day string"


def write_events(t: Tables, files: int = 6) -> str:
    """Events as several Parquet files: adaptive execution would merge partitions without a given number into one."""
    path = fresh_path(t.spark, "stream_in")
    e = t.events.select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    e.repartition(files, "event_id").write.parquet(path)
    return path


def drain(t: Tables, sdf: DataFrame, checkpoint: str, out: str) -> int:
    """Write every batch to a folder of its own and return the number of batches."""
    seen = []

    def land(batch: DataFrame, batch_id: int) -> None:
        seen.append(batch_id)
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = C.stream_for_each_batch(sdf, land, checkpoint=checkpoint)
    q.awaitTermination()
    return len(seen)


def landed(t: Tables, out: str, schema: str) -> DataFrame:
    return t.spark.read.schema(schema).parquet(f"{out}/batch=*")


EVENT_SQL = "select event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') as day from events"


@query("stream_file_source", EVENT_SQL)
def _(t: Tables):
    out = fresh_path(t.spark, "stream_out")
    sdf = C.stream_file_source(t.spark, write_events(t), schema=EVENT, fmt="parquet")
    drain(t, sdf, fresh_path(t.spark, "stream_state"), out)
    return landed(t, out, EVENT)


@query("stream_rate_limit", f"select *, cast(6 as int) as batches from ({EVENT_SQL})")
def _(t: Tables):
    out = fresh_path(t.spark, "stream_out")
    sdf = C.stream_file_source(t.spark, write_events(t), schema=EVENT, fmt="parquet", max_files=1)
    n = drain(t, sdf, fresh_path(t.spark, "stream_state"), out)
    return landed(t, out, EVENT).withColumn("batches", F.lit(n))


@query("stream_drain", EVENT_SQL)
def _(t: Tables):
    out = fresh_path(t.spark, "stream_out")
    sdf = C.stream_file_source(t.spark, write_events(t), schema=EVENT, fmt="parquet", max_bytes=20_000)
    drain(t, sdf, fresh_path(t.spark, "stream_state"), out)
    return landed(t, out, EVENT)


@query("stream_checkpoint", f"select *, cast(case when event_type = 'click' then 2 else 1 end as int) as run from ({EVENT_SQL})")
def _(t: Tables):
    src, state = fresh_path(t.spark, "stream_in"), fresh_path(t.spark, "stream_state")
    e = t.events.select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    outs = [fresh_path(t.spark, "stream_out") for _ in range(3)]
    e.where("event_type <> 'click'").write.mode("append").parquet(src)
    drain(t, C.stream_file_source(t.spark, src, schema=EVENT, fmt="parquet"), state, outs[0])
    e.where("event_type = 'click'").write.mode("append").parquet(src)
    drain(t, C.stream_file_source(t.spark, src, schema=EVENT, fmt="parquet"), state, outs[1])
    # Nothing new: the third run has no batch, so it adds no rows.
    idle = drain(t, C.stream_file_source(t.spark, src, schema=EVENT, fmt="parquet"), state, outs[2])
    first = landed(t, outs[0], EVENT).withColumn("run", F.lit(1 + idle))
    return first.unionByName(landed(t, outs[1], EVENT).withColumn("run", F.lit(2)))


def envelopes(t: Tables) -> DataFrame:
    """All events as JSON envelopes in a binary body, each with the fields of its entity, every seventh one delivered twice."""
    fields = {c: F.col(c).cast("string").alias(c) for c in ("event_id", "user_id", "props")}
    fields |= {"value": money("value").cast("string").alias("value"), "k": F.get_json_object("props", "$.k").alias("k")}
    headers = F.struct(
        F.when(F.col("event_id") % 10 == 9, "DELETE").when(F.col("event_id") % 3 == 0, "INSERT").otherwise("UPDATE").alias("operation"),
        F.lpad(F.col("event_id").cast("string"), 20, "0").alias("changeSequence"),
        F.when(F.col("event_id") % 5 == 0, "").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")).alias("timestamp"))
    entities = [F.when(F.col("event_type") == name, F.struct(*[fields[f.split()[0]] for f in ENTITIES[name].split(", ")])).alias(name) for name in SENT]
    body = F.to_json(F.struct(F.struct(*entities, headers.alias("headers")).alias("message"))).cast("binary").alias("body")
    times = F.when(F.col("event_id") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return t.events.select(body, F.explode(times).alias("copy")).select("body")


ENV_SQL = """env as (select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id, case when event_type in ('click', 'purchase', 'error') then cast(cast(value as decimal(18,2)) as varchar) end as value,
 case when event_type in ('purchase', 'view') then json_extract_string(props, '$.k') end as k, case when event_type = 'error' then props end as props, event_type,
 case when event_id % 10 = 9 then 'DELETE' when event_id % 3 = 0 then 'INSERT' else 'UPDATE' end as message_operation, lpad(cast(event_id as varchar), 20, '0') as message_sequence,
 case when event_id % 5 = 0 then '1900-01-01T00:00:00.000' else left(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 23) end as extraction_time, event_id % 7 = 0 as twice from events),
sent as (select * from env union all select * from env where twice)"""
ENV_COLS = "event_id, user_id, value, k, props, message_operation, message_sequence, extraction_time"


def parsed(t: Tables) -> DataFrame:
    return envelopes(t).select(F.from_json(F.col("body").cast("string"), C.envelope_schema(ENTITIES)).alias("e")).select("e.*")


def _united(frames: dict[str, DataFrame]) -> DataFrame:
    """The rows of all entities under their name, absent fields null."""
    out = None
    for name, frame in frames.items():
        part = frame.select(F.lit(name).alias("entity"), "*")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


@query("cdc_envelope_unpack", f"with {ENV_SQL} select event_type as entity, {ENV_COLS} from sent")
def _(t: Tables):
    events = parsed(t)
    return _united({name: C.cdc_envelope_unpack(events, name) for name in SENT})


@query("cdc_route_entities", f"""
with {ENV_SQL} select event_type as entity, event_id, message_sequence from sent union all select 'absent: returns', null, null from region where r_regionkey = 0""")
def _(t: Tables):
    frames, absent = C.cdc_route_entities(parsed(t), [*ENTITIES, "returns"])
    missing = t.region.where("r_regionkey = 0").select(F.explode(F.array(*[F.lit(f"absent: {a}") for a in absent])).alias("entity"))
    return _united(frames).select("entity", "event_id", "message_sequence").unionByName(missing, allowMissingColumns=True)


@query("stream_dedupe_batch", f"with {ENV_SQL} select distinct event_type as entity, {ENV_COLS} from sent")
def _(t: Tables):
    events = parsed(t)
    return _united({name: C.stream_dedupe_batch(C.cdc_envelope_unpack(events, name)) for name in SENT})


@query("stream_for_each_batch", f"with {ENV_SQL} select event_type as entity, {ENV_COLS} from env")
def _(t: Tables):
    src, out = fresh_path(t.spark, "stream_in"), fresh_path(t.spark, "stream_out")
    # Copies of a message stay in one file and so in one batch, where they are removed.
    envelopes(t).repartition("body").write.parquet(src)
    sdf = C.stream_file_source(t.spark, src, schema="body binary", fmt="parquet")
    entities = {name: ENTITIES[name] for name in SENT}
    C.stream_for_each_batch(sdf, C.land_entities(entities, out), checkpoint=fresh_path(t.spark, "stream_state")).awaitTermination()
    return _united({name: landed_entity(t, out, name) for name in SENT})


def landed_entity(t: Tables, out: str, name: str) -> DataFrame:
    """What a drained stream wrote for one entity."""
    return t.spark.read.schema(ENTITIES[name] + ", message_operation string, message_sequence string, extraction_time string").parquet(f"{out}/{name}/batch=*")


@query("stream_rescue_column", """
select event_id, case when event_id % 9 <> 0 then cast(json_extract(props, '$.k') as int) end as k, case when event_id % 9 = 0 then '{bad ' || props end as rescued from events""")
def _(t: Tables):
    broken = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("{bad "), "props")).otherwise(F.col("props"))
    return C.stream_rescue_column(t.events.select("event_id", broken.alias("props")), "props", schema="k int")


@query("cdc_latest_state", """
with e as (select user_id, event_type, cast(value as decimal(18,2)) as value, event_id as sequence, case when event_id % 10 = 9 then 'DELETE' else 'UPDATE' end as operation from events),
r as (select *, row_number() over (partition by user_id, event_type order by sequence desc) as rn from e)
select user_id, event_type, value, sequence, operation from r where rn = 1 and operation <> 'DELETE'""")
def _(t: Tables):
    e = t.events.select("user_id", "event_type", money("value").alias("value"), F.col("event_id").alias("sequence"),
                        F.when(F.col("event_id") % 10 == 9, "DELETE").otherwise("UPDATE").alias("operation"))
    return C.cdc_latest_state(e, keys=["user_id", "event_type"], sequence="sequence", operation="operation")


STATE = "user_id bigint, event_type string, value decimal(18,2), sequence bigint, operation string"


@query("cdc_kept_state", """
with e as (select user_id, event_type, cast(value as decimal(18,2)) as value, event_id as sequence, case when event_id % 10 = 9 then 'DELETE' else 'UPDATE' end as operation from events),
r as (select *, row_number() over (partition by user_id, event_type order by sequence desc) as rn from e)
select user_id, event_type, value, sequence, operation from r where rn = 1 and operation <> 'DELETE'""")
def _(t: Tables):
    """The same state from three drains that each see new files only; later files bring earlier sequences too."""
    src, state, table = (fresh_path(t.spark, n) for n in ("state_in", "state_checkpoint", "state_table"))
    e = t.events.select("user_id", "event_type", money("value").alias("value"), F.col("event_id").alias("sequence"),
                        F.when(F.col("event_id") % 10 == 9, "DELETE").otherwise("UPDATE").alias("operation"))
    for part in (1, 0, 2):
        e.where(F.pmod(F.xxhash64("sequence"), F.lit(3)) == part).write.mode("append").parquet(src)
        sdf = C.stream_file_source(t.spark, src, schema=STATE, fmt="parquet")
        C.cdc_keep_state(sdf, table, keys=["user_id", "event_type"], sequence="sequence", operation="operation", checkpoint=state).awaitTermination()
    return C.cdc_kept_state(t.spark, table, STATE, operation="operation")
