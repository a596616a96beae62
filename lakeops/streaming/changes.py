"""File streams of change events."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.session import materialise
from lakeops.sources.sinks import replace_partitions, table_exists

# Extraction time where an event carries none, and the envelope's own columns.
NO_TIME = "1900-01-01T00:00:00.000"
ENVELOPE = ("message_operation", "message_sequence", "extraction_time")


def stream_file_source(spark: SparkSession, path: str, *, schema, fmt: str, max_files: int | None = None,
                       max_bytes: int | None = None) -> DataFrame:
    """New files of a folder as a stream, at most so many files or bytes per batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def stream_for_each_batch(sdf: DataFrame, fn: Callable[[DataFrame, int], None], *, checkpoint: str,
                          available_now: bool = True) -> StreamingQuery:
    """Run ``fn(batch, batch_id)`` on every batch.

    ``available_now`` drains what is there and stops; a rerun on the same
    checkpoint sees new files only. ``fn`` may be called again with the same
    id after a failure, so it has to overwrite by batch id.
    """
    writer = sdf.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_rescue_column(df: DataFrame, col: str, *, schema, rescued: str = "rescued") -> DataFrame:
    """Parse JSON; a document that does not parse keeps its text in ``rescued``."""
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    full = T.StructType([*kind.fields, T.StructField(rescued, T.StringType())])
    parsed = F.from_json(F.col(col).cast("string"), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": rescued})
    others = [c for c in df.columns if c != col]
    return df.select(*others, parsed.alias("_p")).select(*others, "_p.*")


def envelope_schema(entities: dict[str, str]) -> T.StructType:
    """Type of ``{message: {<Entity>: {…}, headers: {…}}}`` from a DDL text per entity."""
    headers = T.StructType.fromDDL("operation string, changeSequence string, timestamp string")
    message = T.StructType([*[T.StructField(n, T.StructType.fromDDL(d)) for n, d in entities.items()],
                            T.StructField("headers", headers)])
    return T.StructType([T.StructField("message", message)])


def cdc_envelope_unpack(df: DataFrame, entity: str, *, history: bool = False) -> DataFrame:
    """Entity fields, operation, sequence and time of parsed envelopes; rows without any entity field are dropped.

    A history load, or a blank time, gives 1900-01-01T00:00:00.000.
    """
    fields = df.schema["message"].dataType[entity].dataType.names
    stamp = F.col("message.headers.timestamp")
    time = F.lit(NO_TIME) if history else F.when(F.trim(F.coalesce(stamp, F.lit(""))) == "", NO_TIME).otherwise(stamp)
    rows = df.select(*[F.col(f"message.{entity}.{f}").cast("string").alias(f) for f in fields],
                     F.col("message.headers.operation").alias(ENVELOPE[0]),
                     F.col("message.headers.changeSequence").alias(ENVELOPE[1]), time.alias(ENVELOPE[2]))
    return rows.na.drop("all", subset=fields)


def cdc_route_entities(df: DataFrame, entities: Sequence[str], *, history: bool = False) -> tuple[dict[str, DataFrame], list[str]]:
    """One frame per entity the envelope type knows, and the names of the absent ones."""
    known = df.schema["message"].dataType.names
    present = {e: cdc_envelope_unpack(df, e, history=history) for e in entities if e in known}
    return present, [e for e in entities if e not in known]


def stream_dedupe_batch(df: DataFrame) -> DataFrame:
    """Exact duplicates inside a batch removed."""
    return df.dropDuplicates()


def land_entities(entities: dict[str, str], dest: str, *, body: str = "body", history: bool = False) -> Callable[[DataFrame, int], None]:
    """A batch function: parse the envelope once, route, dedupe and write each entity.

    Everything lands in a folder named after the batch, overwritten if the batch is run again.
    """
    schema = envelope_schema(entities)

    def land(batch: DataFrame, batch_id: int) -> None:
        parsed = batch.select(F.from_json(F.col(body).cast("string"), schema).alias("_e")).select("_e.*")
        parsed.persist()
        try:
            frames, _ = cdc_route_entities(parsed, list(entities), history=history)
            for name, frame in frames.items():
                stream_dedupe_batch(frame).write.mode("overwrite").parquet(f"{dest}/{name}/batch={batch_id}")
        finally:
            parsed.unpersist()

    return land


def cdc_latest_state(df: DataFrame, *, keys: Sequence[str], sequence: str, operation: str, delete: str = "DELETE") -> DataFrame:
    """The current row per key: the highest sequence wins, deleted keys vanish.

    On an equal sequence a delete wins, then the other columns decide. A
    maximum over row structs, combined before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in (sequence, operation)]
    deleted = (F.upper(F.col(operation)) == delete).alias("_deleted")
    last = df.groupBy(*keys).agg(F.max(F.struct(sequence, deleted, operation, *rest)).alias("_r"))
    return last.select(*keys, "_r.*").where(F.upper(F.col(operation)) != delete).select(*df.columns)


def cdc_keep_state(sdf: DataFrame, table: str, *, keys: Sequence[str], sequence: str, operation: str, checkpoint: str,
                   delete: str = "DELETE", buckets: int = 16, available_now: bool = True) -> StreamingQuery:
    """Keep the newest row of each key of a change stream in ``table``, over all drains with one ``checkpoint``.

    The state of a key is the row with the highest sequence seen in any batch,
    kept by Spark's streaming aggregate; a later batch with a lower sequence
    changes nothing, and on an equal one a delete wins. A deleted key stays as
    a tombstone, in the state and in the table, so a late change cannot bring
    it back. Keys are dealt over ``buckets`` partitions of the table by hash; a
    batch rewrites the partitions of its own keys, in one commit, and gives the
    same table if it is run again.
    """
    columns = sdf.columns
    rest = [c for c in columns if c not in keys and c not in (sequence, operation)]
    deleted = (F.upper(F.col(operation)) == delete).alias("_deleted")
    newest = sdf.groupBy(*keys).agg(F.max(F.struct(sequence, deleted, operation, *rest)).alias("_r"))
    changed = newest.select(*keys, "_r.*").drop("_deleted").select(*columns)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        new = materialise(batch.select(*columns, bucket), name="state-changes")
        there = table_exists(batch.sparkSession, table)
        if there:
            old = batch.sparkSession.read.schema(new.schema).parquet(table).select(*new.columns)
            touched = old.join(new.select("bucket").distinct(), "bucket", "left_semi").select(*new.columns)
            same = [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys]
            kept = touched.join(new.select(*[F.col(k).alias(f"_n_{k}") for k in keys]), same, "left_anti")
            new = materialise(kept.unionByName(new), name="state-rows")
        replace_partitions(new, table, ["bucket"])

    writer = changed.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def cdc_kept_state(spark: SparkSession, table: str, schema, *, operation: str, delete: str = "DELETE") -> DataFrame:
    """The current rows of a kept state: its table without tombstones."""
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    rows = spark.read.schema(T.StructType([*kind.fields, T.StructField("bucket", T.IntegerType())])).parquet(table)
    return rows.where(F.upper(F.col(operation)) != delete).select(*kind.names)
