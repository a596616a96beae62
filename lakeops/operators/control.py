"""Watermarks, run logs, restart flags and reconciliation, as small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The layers a feed is counted in, first to last.
STAGES = ("curate_stage", "curate_standard", "curate_store", "curate_warehouse")


def watermark_append(tgt: DataFrame, rows: DataFrame) -> DataFrame:
    """Add (source, feed, batch, last_time) rows."""
    return tgt.unionByName(rows.select(*tgt.columns))


def _bare(c: Column) -> Column:
    return F.regexp_replace(c, r"""["'\[\]]""", "")


def run_log_append(tgt: DataFrame, entries: DataFrame, *, load_type: str) -> DataFrame:
    """Log rows of finished runs.

    ``entries`` has the log's columns with ``entity_name`` as the run gave it:
    a list of ``(name, source, target)`` tuples for ``History``, a list of
    names for ``Incremental``, one name otherwise, where the target count is
    the number at the end of its text.
    """
    others = [c for c in tgt.columns if c not in ("entity_name", "source_count", "target_count")]
    clean = entries.withColumns({c: _bare(F.col(c)) for c in others if entries.schema[c].dataType.simpleString() == "string"})
    if load_type == "History":
        tuples = F.regexp_extract_all(F.col("entity_name"), F.lit(r"\(([^()]*)\)"), F.lit(1))
        one = clean.withColumn("_t", F.explode(tuples))
        parts = F.split(_bare(F.col("_t")), r"\s*,\s*")
        rows = one.withColumns({"entity_name": F.trim(parts[0]), "source_count": F.trim(parts[1]), "target_count": F.trim(parts[2])})
    elif load_type == "Incremental":
        rows = clean.withColumn("entity_name", F.explode(F.split(_bare(F.col("entity_name")), ",")))
        rows = rows.withColumn("entity_name", F.trim("entity_name"))
    else:
        tail = F.regexp_replace(F.element_at(F.split(F.element_at(F.split("target_count", ","), -1), ":"), -1), r"\}", "")
        rows = clean.withColumns({"entity_name": _bare(F.col("entity_name")), "target_count": F.trim(_bare(tail))})
    types = {f.name: f.dataType for f in tgt.schema}
    return tgt.unionByName(rows.select(*[F.col(c).cast(types[c]).alias(c) for c in tgt.columns]))


def control_flag_transition(log: DataFrame, *, feed: str, event: str, run: str | None = None) -> DataFrame:
    """One transition of the restart log (feed_name, start_date, end_date, active_flag, restart_flag).

    ``run_begin`` and ``run_end`` frame a normal run of the feeds starting
    with ``feed``; ``restart_begin`` and ``restart_end`` a repeated one. The
    begin events park other active rows and add the row of ``run``.
    """
    mine = F.col("feed_name").startswith(feed)
    a, r = F.col("active_flag"), F.col("restart_flag")
    live = (a == "Y") & (r == "N")
    new_row = None
    if run is not None:
        new_row = (F.col("feed_name") == run) & (F.col("start_date") == "") & (F.col("end_date") == "")
    if event == "run_begin":
        out = log.withColumn("active_flag", F.when(live & mine, "N").when(live, "A").otherwise(a))
    elif event == "run_end":
        out = log.withColumn("active_flag", F.when((a == "P") & (r == "N") & new_row, "Y")
                             .when((a == "A") & (r == "N"), "Y").otherwise(a))
    elif event == "restart_begin":
        out = log.withColumns({
            "restart_flag": F.when((r == "Y") & mine, "R").when((a == "N") & (r == "Y"), "A").otherwise(r),
            "active_flag": F.when(live, "A").otherwise(a)})
    elif event == "restart_end":
        out = log.withColumns({
            "active_flag": F.when((a == "P") & (r == "N") & new_row, "N").when((a == "A") & (r == "N"), "Y").otherwise(a),
            "restart_flag": F.when((a == "N") & (r == "A"), "Y").when((r == "R") & mine, "Y").otherwise(r)})
    else:
        raise ValueError(f"unknown event {event}")
    if event.endswith("_begin") and run is not None:
        row = log.sparkSession.range(1).select(
            F.lit(run).alias("feed_name"), F.lit("").alias("start_date"), F.lit("").alias("end_date"),
            F.lit("P").alias("active_flag"), F.lit("N").alias("restart_flag"))
        out = out.unionByName(row)
    return out


def next_extract_window(log: DataFrame, *, feed: str, days: int) -> DataFrame:
    """The next span of each feed starting with ``feed``: the day after its last end, ``days`` long."""
    ends = log.where(F.col("feed_name").startswith(feed)).groupBy("feed_name").agg(F.max("end_date").alias("last_end"))
    end = F.col("last_end").cast("date")
    return ends.select("feed_name", F.date_add(end, 1).alias("start_date"), F.date_add(end, days).alias("end_date"))


def stage_reconciliation(counts: DataFrame, bad: DataFrame, *, keys: Sequence[str], strict: bool,
                         stages: Sequence[str] = STAGES) -> DataFrame:
    """One row per entity and stage with its count, its bad rows and a verdict.

    ``counts`` has the keys, stage and n; ``bad`` the keys and bad_rows, shown
    at the second stage. Strict: all four counts agree. Otherwise the last two
    agree and the first is above zero. Entities without first-stage rows are left out.
    """
    wide = counts.groupBy(*keys).pivot("stage", list(stages)).agg(F.sum("n"))
    wide = wide.fillna(0, list(stages)).where(F.col(stages[0]) > 0)
    s = [F.col(x) for x in stages]
    ok = (s[0] == s[1]) & (s[1] == s[2]) & (s[2] == s[3]) if strict else (s[2] == s[3]) & (s[0] > 0)
    per_key = bad.groupBy(*keys).agg(F.sum("bad_rows").alias("bad_rows"))
    wide = wide.join(per_key, list(keys), "left").withColumn("verdict", F.when(ok, "equal").otherwise("not equal"))
    long = wide.select(*keys, "verdict", "bad_rows", F.posexplode(F.create_map(
        *[x for st in stages for x in (F.lit(st), F.col(st))])).alias("_i", "stage", "n"))
    return long.select(*keys, "stage", "n",
                       F.when(F.col("stage") == stages[1], F.coalesce("bad_rows", F.lit(0))).alias("bad_rows"), "verdict")


def batch_reconciliation(df: DataFrame, *, entity: str, batch: str) -> DataFrame:
    """Messages of the batch, rows and distinct rows per entity."""
    unique = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    per = unique.groupBy(batch, entity).agg(F.sum("_copies").alias("total_rows"), F.count(F.lit(1)).alias("unique_rows"))
    messages = per.groupBy(batch).agg(F.sum("total_rows").alias("messages"))
    return per.join(messages, batch)


def bad_row_register(tgt: DataFrame, counts: DataFrame, *, joint_ids: Sequence[str]) -> DataFrame:
    """Append bad-row counts above zero; feeds delivered together share one joint id."""
    feed = F.when(F.col("feed_id").isin(list(joint_ids)), ",".join(joint_ids)).otherwise(F.col("feed_id"))
    return tgt.unionByName(counts.where("bad_rows > 0").withColumn("feed_id", feed).select(*tgt.columns))


def feed_counts_row(source_df: DataFrame, dest_df: DataFrame, *, names: tuple[str, str]) -> DataFrame:
    """Source and destination counts of a feed as one row."""
    n = F.count(F.lit(1))
    return source_df.agg(n.alias("source_count")).select(
        F.lit(names[0]).alias("source_name"), "source_count", F.lit(names[1]).alias("destination_name"),
        dest_df.agg(n).scalar().alias("destination_count"))
