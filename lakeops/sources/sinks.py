"""Writers. Each returns the written data, read back from its target.

A target is never overwritten while it is being read: a rewrite goes to a new
folder first and is moved into place as whole partitions by Spark's dynamic
partition overwrite, or is returned as a new version folder.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from lakeops.session import materialise

# Default sizes of extracts and of a single landing file.
DEFAULT_EXTRACT_BYTES = 1024 ** 3
DEFAULT_EXTRACT_ROWS = 100_000
SINGLE_FILE_BYTES = 3 * 1024 ** 3
# Fixed value: text that one task writes where a table may have several files.
PART_BYTES = 256 * 1024 ** 2


# One set of options for every CSV file written or read back here: a null is the text \\N and an empty text is a
# pair of quotes, quotes inside a value are doubled, blanks stay, and a value may hold line breaks.
CSV_OPTIONS = {
    "header": True, "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": '""', "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _save(writer: DataFrameWriter, fmt: str, dest: str) -> None:
    writer.format(fmt).options(**CSV_OPTIONS if fmt == "csv" else {}).save(dest)


def _back(df: DataFrame, dest: str, fmt: str) -> DataFrame:
    reader = df.sparkSession.read.schema(df.schema).format(fmt)
    return (reader.options(**CSV_OPTIONS | {"emptyValue": "", "multiLine": True}) if fmt == "csv" else reader).load(dest)


def _clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of one table partition in few tasks; adaptive execution splits a large one."""
    return df.hint("rebalance", *keys) if keys else df


def write_run_folder(df: DataFrame, dest: str, *, run_date: str, run_time: str, fmt: str = "parquet") -> DataFrame:
    """Append below ``dest/<run_date><run_time>``."""
    target = f"{dest}/{run_date}{run_time}"
    _save(df.write.mode("append"), fmt, target)
    return _back(df, target, fmt)


def write_partitioned_append(df: DataFrame, dest: str, *, keys: Sequence[str], fmt: str = "parquet",
                             where: str | None = None) -> DataFrame:
    """Append partitioned by ``keys``; ``where`` keeps only some rows."""
    kept = df.where(where) if where else df
    _save(_clustered(kept, keys).write.mode("append").partitionBy(*keys), fmt, dest)
    return _back(df, dest, fmt).select(*df.columns)


def append_to_table(df: DataFrame, dest: str) -> DataFrame:
    """Append to a Parquet table."""
    df.write.mode("append").parquet(dest)
    return _back(df, dest, "parquet")


def append_once(df: DataFrame, dest: str, *, keys: Sequence[str] = (), staged: str, tag: str) -> DataFrame:
    """Append under a ``tag``; again under the same tag adds nothing that is there. Returns the table.

    Rows are written to ``staged`` first. Their files are then moved to the
    table, each under a name of the tag and its number, so a run that died
    between two moves goes on with the files that are left.
    """
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(dest).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(f"{staged}/_SUCCESS")):
        writer = (_clustered(df, keys) if keys else df).write.mode("overwrite")
        (writer.partitionBy(*keys) if keys else writer).parquet(staged)
    root = fs.makeQualified(path(staged)).toUri().getPath()
    found, listed = [], fs.listFiles(path(staged), True)
    while listed.hasNext():
        found.append(listed.next().getPath())
    for source in found:
        folder, name = source.toUri().getPath()[len(root) :].strip("/").rpartition("/")[::2]
        if name.startswith("part-"):
            target = path("/".join(x for x in (dest, folder, f"part-{tag}-{name[5:]}") if x))
            fs.mkdirs(target.getParent())
            if not fs.exists(target) and not fs.rename(source, target):
                raise OSError(f"could not move {source} to {target}")
    return _back(df, dest, "parquet").select(*df.columns)


def truncate_and_load(df: DataFrame, dest: str) -> DataFrame:
    """Replace the whole table."""
    df.write.mode("overwrite").parquet(dest)
    return _back(df, dest, "parquet")


def replace_partitions(df: DataFrame, dest: str, keys: Sequence[str]) -> None:
    """Replace the partitions that ``df`` brings, in one commit."""
    (_clustered(df, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(dest))


def _drop_partitions(spark: SparkSession, dest: str, key: str, values: Sequence) -> None:
    """Remove whole partition folders of a table with one partition column."""
    drop_partition_folders(spark, dest, [key], [(v,) for v in values])


def drop_partition_folders(spark: SparkSession, dest: str, keys: Sequence[str], values: Sequence[Sequence]) -> None:
    """Remove whole partition folders of a table, named by one value per partition column."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for row in values:
        path = jvm.org.apache.hadoop.fs.Path("/".join([dest, *(name(k, None if v is None else str(v)) for k, v in zip(keys, row))]))
        path.getFileSystem(conf).delete(path, True)


def _partition_values(spark: SparkSession, dest: str, schema, key: str, keep: Column) -> list:
    """Partition values for which ``keep`` holds; read from folder names, so bounded by the folder count."""
    table = spark.read.schema(schema).parquet(dest)
    return _values(table.where(keep), key)


def table_exists(spark: SparkSession, dest: str) -> bool:
    """Whether there is a folder at ``dest``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(dest)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def partition_rows(df: DataFrame) -> list:
    """Rows of partition values: as many as the table has folders at most."""
    return df.distinct().collect()


def _values(df: DataFrame, key: str) -> list:
    """Distinct partition values."""
    return [r[0] for r in partition_rows(df.select(key))]


def replace_recent_partitions(df: DataFrame, dest: str, *, key: str, cutoff, keep_from=None) -> DataFrame:
    """Drop partitions with ``key >= cutoff``, add ``df``, and return rows from ``keep_from`` on.

    New partitions replace old ones in one commit; then old ones without a
    successor go. Running it again gives the same table.
    """
    spark = df.sparkSession
    fresh = materialise(df, name="recent")
    stale = _partition_values(spark, dest, df.schema, key, F.col(key) >= F.lit(cutoff))
    replace_partitions(fresh, dest, [key])
    brought = set(_values(fresh, key))
    _drop_partitions(spark, dest, key, [v for v in stale if v not in brought])
    table = _back(df, dest, "parquet").select(*df.columns)
    return table if keep_from is None else table.where(F.col(key) >= F.lit(keep_from))


def delete_where_and_append(df: DataFrame, dest: str, *, key: str) -> DataFrame:
    """Replace the partitions of ``key`` that ``df`` brings, leaving the others untouched."""
    replace_partitions(df, dest, [key])
    return _back(df, dest, "parquet").select(*df.columns)


def delete_all_rows(spark: SparkSession, dest: str) -> DataFrame:
    """Empty a table but keep its columns."""
    schema = spark.read.parquet(dest).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(dest)
    return spark.read.schema(schema).parquet(dest)


def delete_where(table: DataFrame, *, where: str) -> DataFrame:
    """Rows for which ``where`` is not true (false or unknown both stay)."""
    return table.where(~F.coalesce(F.expr(where), F.lit(False)))


def delete_where_from(spark: SparkSession, dest: str, *, key: str, where: str) -> DataFrame:
    """Delete from a table partitioned by ``key``, rewriting only the partitions that lose rows."""
    table = spark.read.parquet(dest)
    schema = table.schema
    touched = _values(table.where(F.expr(where)), key)
    if touched:
        hit = F.col(key).isin([v for v in touched if v is not None])
        if None in touched:
            hit = F.coalesce(hit, F.lit(False)) | F.col(key).isNull()
        kept = materialise(delete_where(table.where(hit), where=where), name="kept")
        replace_partitions(kept, dest, [key])
        left = set(_values(kept, key))
        _drop_partitions(spark, dest, key, [v for v in touched if v not in left])
    return spark.read.schema(schema).parquet(dest).select(*schema.names)


def retain_recent(spark: SparkSession, dest: str, *, key: str, cutoff) -> DataFrame:
    """Drop the partitions of a table older than ``cutoff``."""
    schema = spark.read.parquet(dest).schema
    old = _partition_values(spark, dest, schema, key, F.col(key) < F.lit(cutoff))
    _drop_partitions(spark, dest, key, old)
    return spark.read.schema(schema).parquet(dest)


def write_nonempty_csv(frames: Mapping[str, DataFrame], base: str, *, run_date: str, run_time: str) -> DataFrame:
    """Header CSV for each frame with rows; returns the names written and their folders. Each frame is computed once."""
    written = []
    for name, df in frames.items():
        stored = materialise(df, name="output")
        if not stored.isEmpty():
            target = f"{base}/{name}/{run_date}{run_time}"
            _save(stored.write.mode("append"), "csv", target)
            written.append((name, target))
    return SparkSession.active().createDataFrame(written, "output string, folder string")


def fan_out_destinations(df: DataFrame, targets: Sequence[Mapping]) -> dict[str, DataFrame]:
    """Write one frame to many targets: ``{path, query?, mode?, keys?}``.

    The frame is written once to the shared folder, so each target reads
    stored rows. A query names the frame ``{source}``.
    """
    spark = df.sparkSession
    stored = materialise(df, name="fanout") if len(targets) > 1 else df
    results = {}
    for t in targets:
        out = spark.sql(t["query"], source=stored) if t.get("query") else stored
        if t.get("keys"):
            results[t["path"]] = write_partitioned_append(out, t["path"], keys=t["keys"])
        elif t.get("mode", "append") == "overwrite":
            results[t["path"]] = truncate_and_load(out, t["path"])
        else:
            results[t["path"]] = append_to_table(out, t["path"])
    return results


def split_by_rows(df: DataFrame, dest: str, *, rows: int = DEFAULT_EXTRACT_ROWS, fmt: str = "csv") -> DataFrame:
    """Files of at most ``rows`` rows, written in parallel."""
    _save(df.write.mode("overwrite").option("maxRecordsPerFile", rows), fmt, dest)
    return _back(df, dest, fmt)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as delimited text."""
    return sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns),
               F.lit(len(df.columns)))


def split_by_size(df: DataFrame, dest: str, *, max_bytes: int = DEFAULT_EXTRACT_BYTES, margin: float = 0.1,
                  fmt: str = "csv") -> DataFrame:
    """Files of at most about ``max_bytes``: as many as all rows need with a margin and room for quoting.

    Rows are dealt out evenly, so a file holds about the mean size of its rows,
    and one wide row adds its own bytes only. The frame is computed once.
    """
    stored = materialise(df, name="extract")
    _save(_in_files(stored, max_bytes / (1 + margin), 2 * len(df.columns)).write.mode("overwrite"), fmt, dest)
    return _back(df, dest, fmt)


def _in_files(stored: DataFrame, max_bytes: float, more_per_row: int = 0) -> DataFrame:
    """Rows dealt out to one task for each ``max_bytes`` of text, at any size."""
    return _dealt(stored, _text_bytes(stored, more_per_row), max_bytes)


def _text_bytes(stored: DataFrame, more_per_row: int = 0) -> int:
    """Bytes of all rows as delimited text."""
    return int(stored.agg(F.sum(row_bytes(stored) + more_per_row)).first()[0] or 0)


def _dealt(stored: DataFrame, size: int, max_bytes: float) -> DataFrame:
    return stored.repartition(max(1, math.ceil(size / max_bytes)))


def _stored_bytes(spark: SparkSession, glob: str) -> tuple[int, int]:
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(glob)
    row = listing.agg(F.sum("length"), F.count(F.lit(1))).first()
    return int(row[0] or 0), int(row[1])


def compact_small_files(spark: SparkSession, glob: str, dest: str, *, target_bytes: int, schema, sep: str = "|",
                        header: bool = True, escape: str = "\\") -> DataFrame:
    """Merge the small files of a delimited table into quoted CSV files of about ``target_bytes``.

    ``escape`` is the character before a quote inside a value in the small files.
    """
    total, _ = _stored_bytes(spark, glob)
    parts = max(1, math.ceil(total / target_bytes))
    df = spark.read.csv(glob, schema=schema, sep=sep, header=header, recursiveFileLookup=True, multiLine=True, quote='"', escape=escape, lineSep="\n")
    _save(df.repartition(parts).write.mode("overwrite").option("quoteAll", True), "csv", dest)
    return _back(df, dest, "csv")


def size_guarded_parquet(df: DataFrame, dest: str, *, max_bytes: int = SINGLE_FILE_BYTES) -> DataFrame:
    """One file up to ``max_bytes`` of text, above it files of a task's share, written in parallel; the frame is computed once.

    The one file is written from the stored columns without a shuffle of rows,
    which are several times larger.
    """
    stored = materialise(df, name="guarded", compression="zstd")
    size = _text_bytes(stored)
    out = stored.coalesce(1) if size <= max_bytes else _dealt(stored, size, min(max_bytes, PART_BYTES))
    out.write.mode("overwrite").parquet(dest)
    return _back(df, dest, "parquet")


def quarantine_bad_rows(df: DataFrame, dest: str, *, run: str) -> DataFrame:
    """Append failed rows with their error text below the run's folder."""
    target = f"{dest}/{run}"
    df.write.mode("append").parquet(target)
    return _back(df, target, "parquet")


def write_report_json(report_df: DataFrame, dest: str) -> DataFrame:
    """A report as JSON lines."""
    report_df.write.mode("append").json(dest)
    return report_df.sparkSession.read.schema(report_df.schema).json(dest)

