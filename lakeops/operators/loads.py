"""Incremental loads and slowly changing dimensions on plain Parquet.

Each operator returns the new target as a frame. A target is joined once with
the (smaller) source; its untouched rows pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.aggs import dedupe_by
from lakeops.operators.clean import OPEN_END, OPEN_START
from lakeops.operators.joins import anti_left_join_null
from lakeops.session import materialise
from lakeops.sources.sinks import drop_partition_folders, partition_rows, replace_partitions, truncate_and_load

FLAG, START, END = "scd_active_flag", "record_start_date", "record_end_date"
CREATED, UPDATED = "create_datetime", "update_datetime"


def _stamp(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def one_per_key(src: DataFrame, keys: Sequence[str], order_col: str | None) -> DataFrame:
    """The newest source row per key; all other columns break ties."""
    return dedupe_by(src, keys, [order_col] if order_col else [], descending=True)


def incremental_since(df: DataFrame, target: DataFrame, *, ts: str, target_ts: str | None = None) -> DataFrame:
    """Rows newer than the target's newest; all rows while the target is empty."""
    newest = target.agg(F.max(target_ts or ts).alias("t")).scalar()
    return df.where(F.col(ts) > F.coalesce(newest, F.lit("1900-01-01 00:00:00").cast(df.schema[ts].dataType)))


def scd1_upsert(src: DataFrame, tgt: DataFrame, *, keys: Sequence[str], update_cols: Sequence[str], as_of: str,
                order_col: str | None = None) -> DataFrame:
    """Matched keys take the listed columns and an update time; new keys are inserted.

    With ``order_col``, a source row older than its target row changes nothing.
    """
    fresh = one_per_key(src.select(*dict.fromkeys([*keys, *update_cols, *([order_col] if order_col else [])])), keys, order_col)
    s = fresh.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in fresh.columns if c not in keys], F.lit(True).alias("_new"))
    t = tgt.withColumn("_old", F.lit(True))
    j = t.join(s, list(keys), "full")
    insert = F.col("_old").isNull()
    hit = F.col("_new").isNotNull() & ~insert
    if order_col:
        hit = hit & (F.col(f"_s_{order_col}") >= F.col(order_col))
    out = []
    for c in tgt.columns:
        if c in keys:
            out.append(F.col(c))
        elif c == CREATED:
            out.append(F.when(insert, _stamp(as_of)).otherwise(F.col(c)).alias(c))
        elif c == UPDATED:
            out.append(F.when(hit, _stamp(as_of)).otherwise(F.col(c)).alias(c))
        elif c in fresh.columns:
            out.append(F.when(insert | hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def scd2_start_date(src: DataFrame, tgt: DataFrame, *, keys: Sequence[str], as_of: str) -> DataFrame:
    """Start date of each incoming version: 1900 for a key never seen, else now."""
    known = tgt.where(F.col(FLAG) == "Y").select(*keys).distinct().withColumn("_known", F.lit(True))
    start = F.when(F.col("_known"), _stamp(as_of)).otherwise(F.lit(OPEN_START).cast("timestamp_ntz"))
    return src.join(known, list(keys), "left").withColumn(START, start).drop("_known")


def scd2_changed_rows(src: DataFrame, tgt: DataFrame, *, cols: Sequence[str], active: str = "Y") -> DataFrame:
    """Incoming rows that differ from every active version in the tracked columns, null equal to null."""
    return anti_left_join_null(src, tgt.where(F.col(FLAG) == active), cols)


def scd2_upsert(src: DataFrame, tgt: DataFrame, *, keys: Sequence[str], cols: Sequence[str], as_of: str,
                order_col: str | None = None, active: tuple[str, str] = ("Y", "N"), end_mode: str = "contiguous",
                delete_flag: tuple[str, str] | None = None) -> DataFrame:
    """Close the active version of each incoming key and add the incoming row as the active one.

    ``end_mode`` ``contiguous`` ends the old version when the new one starts,
    ``minus_1_day`` a day before. With ``order_col``, a source row older than
    the active version is left out, so a key never has two active versions.
    ``delete_flag`` is a ``(column, value)`` that closes without a new version.
    """
    if end_mode not in ("contiguous", "minus_1_day"):
        raise ValueError(f"unknown end_mode {end_mode}")
    yes, no = active
    now = _stamp(as_of)
    incoming = one_per_key(src, keys, order_col)
    is_active = F.col(FLAG) == yes
    marks = incoming.select(*keys, *([F.col(order_col).alias("_s_order")] if order_col else []), F.lit(True).alias("_hit"))
    joined = tgt.join(marks, list(keys), "left")
    close = is_active & F.coalesce(F.col("_hit"), F.lit(False))
    if order_col:
        close = close & (F.col("_s_order") >= F.col(order_col))
    ended = now if end_mode == "contiguous" else now - F.expr("interval 1 day")
    changed = {FLAG: F.lit(no), END: ended, UPDATED: now}
    kept = joined.select(*[
        F.when(F.coalesce(close, F.lit(False)), changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in tgt.columns])

    if order_col:
        current = tgt.where(is_active).select(*keys, F.col(order_col).alias("_t_order"))
        incoming = incoming.join(current, list(keys), "left").where(
            F.col("_t_order").isNull() | (F.col(order_col) >= F.col("_t_order"))).drop("_t_order")
    if delete_flag:
        incoming = incoming.where(F.coalesce(F.col(delete_flag[0]) != delete_flag[1], F.lit(True)))
    types = {f.name: f.dataType for f in tgt.schema}
    fixed = {
        FLAG: F.lit(yes),
        START: F.col(START) if START in incoming.columns else now,
        END: F.lit(OPEN_END).cast("timestamp_ntz"),
        CREATED: now,
        UPDATED: F.lit(None),
    }
    known = {*keys, *cols, *([order_col] if order_col else [])}
    added = incoming.select(*[
        (fixed[c] if c in fixed else F.col(c) if c in known and c in incoming.columns else F.lit(None)).cast(types[c]).alias(c)
        for c in tgt.columns])
    return kept.unionByName(added)


def new_dimension(src: DataFrame, *, as_of: str, start: str = OPEN_START) -> DataFrame:
    """The first load of a dimension: every row is active."""
    return src.withColumns({
        FLAG: F.lit("Y"),
        START: F.lit(start).cast("timestamp_ntz"),
        END: F.lit(OPEN_END).cast("timestamp_ntz"),
        CREATED: _stamp(as_of),
        UPDATED: F.lit(None).cast("timestamp_ntz"),
    })


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scd1_folder(src: DataFrame, path: str, *, keys: Sequence[str], as_of: str, partition_keys: Sequence[str] = (),
                order_col: str | None = None) -> DataFrame:
    """SCD-1 into a Parquet folder; the first load creates it.

    With ``partition_keys`` the partitions that the source brings and those
    that hold any of its keys now are read and rewritten, so a key that moves
    leaves its old partition. Finding them reads keys and partition columns
    only. The result is stored before its target is replaced. A load that dies
    while it replaces partitions can be run again: a key that then stands in two
    partitions counts with its newer row, and the older one goes.
    """
    spark = src.sparkSession
    cols = [c for c in src.columns if c not in keys]
    if not _exists(spark, path):
        first = one_per_key(src, keys, order_col).withColumns({
            CREATED: _stamp(as_of), UPDATED: F.lit(None).cast("timestamp_ntz")})
        writer = first.write.partitionBy(*partition_keys) if partition_keys else first.write
        writer.parquet(path)
        return spark.read.schema(first.schema).parquet(path)
    schema = spark.read.parquet(path).schema
    tgt = spark.read.schema(schema).parquet(path)
    parts = list(partition_keys)
    if parts:
        held = tgt.join(src.select(*[F.col(k).alias(f"_s_{k}") for k in keys]), [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys], "left_semi").select(*parts)
        touched = materialise(held.union(src.select(*parts)).distinct(), name="touched").select(*[F.col(k).alias(f"_t_{k}") for k in parts])
        tgt = tgt.join(touched, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in parts], "left_semi")
        # A load that died between its two steps left a moved key in both partitions: the newer row counts.
        stamp = F.coalesce(F.col(UPDATED), F.col(CREATED))
        tgt = one_per_key(tgt.withColumn("_stamp", stamp), keys, "_stamp").drop("_stamp")
    new = materialise(scd1_upsert(src, tgt, keys=keys, update_cols=cols, as_of=as_of, order_col=order_col), name="scd1")
    if partition_keys:
        emptied = touched.join(new.select(*parts).distinct(), [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in parts], "left_anti")
        gone = partition_rows(emptied)
        replace_partitions(new, path, parts)
        drop_partition_folders(spark, path, parts, gone)
        return spark.read.schema(schema).parquet(path)
    return truncate_and_load(new, path)


def scd2_folder(src: DataFrame, path: str, *, keys: Sequence[str], compare: Sequence[str], as_of: str,
                active: tuple[str, str] = ("Y", "N"), end_mode: str = "contiguous", order_col: str | None = None,
                load_id: str | None = None) -> DataFrame:
    """SCD-2 into a Parquet folder; the first load creates it.

    The folder is partitioned by the active flag and by the run that closed a
    row. A load reads and rewrites the active partition only and adds one
    partition of closed rows, in one commit; older history is never touched.
    ``load_id`` names that partition and must be new to the folder; by default
    it is, also for two loads with one ``as_of``. A load that runs again finds
    its rows unchanged and closes nothing.
    """
    spark = src.sparkSession
    run = "closed_run"
    cols = [c for c in src.columns if c not in keys]
    if not _exists(spark, path):
        first = new_dimension(one_per_key(src, keys, order_col), as_of=as_of).withColumn(FLAG, F.lit(active[0]))
        first.withColumn(run, F.lit("open")).write.partitionBy(FLAG, run).parquet(path)
    else:
        columns = spark.read.parquet(path).drop(run).columns
        current = spark.read.parquet(path).where(F.col(FLAG) == active[0]).select(*columns)
        incoming = scd2_changed_rows(src, current, cols=[*keys, *compare], active=active[0])
        merged = scd2_upsert(incoming, current, keys=keys, cols=cols, as_of=as_of, active=active, end_mode=end_mode,
                             order_col=order_col)
        label = F.when(F.col(FLAG) == active[0], "open").otherwise(load_id or "r" + "".join(ch for ch in as_of if ch.isdigit()) + "-" + uuid.uuid4().hex[:12])
        stored = materialise(merged.withColumn(run, label), name="scd2")
        replace_partitions(stored, path, [FLAG, run])
    return spark.read.parquet(path).drop(run)


def merge_count(src: DataFrame, tgt: DataFrame, *, keys: Sequence[str], cols: Sequence[str], kind: str = "scd1") -> DataFrame:
    """How many rows a merge would insert, update or close, and leave as they are."""
    t = tgt.where(F.col(FLAG) == "Y") if kind == "scd2" else tgt
    s = one_per_key(src.select(*keys, *cols), keys, None).select(*keys, F.struct(*cols).alias("_s"), F.lit(True).alias("_new"))
    j = t.select(*keys, F.struct(*cols).alias("_t"), F.lit(True).alias("_old")).join(s, list(keys), "full")
    action = (F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "keep")
              .when(F.col("_s").eqNullSafe(F.col("_t")), "keep").otherwise("update"))
    return j.groupBy(action.alias("action")).agg(F.count(F.lit(1)).alias("n"))


def merge_update_only(tgt: DataFrame, src: DataFrame, *, on: Sequence[str], set_cols: Sequence[str], where: str | None = None) -> DataFrame:
    """Set columns on match (and ``where``), insert nothing."""
    s = one_per_key(src.select(*on, *set_cols), on, None).select(
        *on, *[F.col(c).alias(f"_s_{c}") for c in set_cols], F.lit(True).alias("_hit"))
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & (F.coalesce(F.expr(where), F.lit(False)) if where else F.lit(True))
    j = tgt.join(s, list(on), "left")
    return j.select(*[F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c) for c in tgt.columns])


def merge_upsert_column(tgt: DataFrame, src: DataFrame, *, keys: Sequence[str], col: str) -> DataFrame:
    """Set one column on match; insert the keys and that column otherwise."""
    s = one_per_key(src.select(*keys, col), keys, None).select(*keys, F.col(col).alias("_s"), F.lit(True).alias("_new"))
    j = tgt.join(s, list(keys), "full")
    return j.select(*[F.when(F.col("_new"), F.col("_s")).otherwise(F.col(c)).alias(c) if c == col else F.col(c) for c in tgt.columns])


def upsert_by_keys(src: DataFrame, tgt: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; the rest stays."""
    fresh = one_per_key(src, keys, None)
    return tgt.join(fresh.select(*keys), list(keys), "left_anti").select(*tgt.columns).unionByName(fresh.select(*tgt.columns))


def apply_merge(src: DataFrame, tgt: DataFrame, spec: Mapping) -> DataFrame:
    """Merge by a recipe entry: ``{merge: scd1|scd2|upsert, keys, cols, as_of}``."""
    if spec["merge"] == "scd1":
        return scd1_upsert(src, tgt, keys=spec["keys"], update_cols=spec["cols"], as_of=spec["as_of"])
    if spec["merge"] == "scd2":
        return scd2_upsert(src, tgt, keys=spec["keys"], cols=spec["cols"], as_of=spec["as_of"])
    return upsert_by_keys(src, tgt, keys=spec["keys"])
