"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}

# Set on any session the queries run in: a skewed join is split even where a later step then needs a shuffle,
# and a task gets so many bytes at most, as hash tables, XML and text are many times larger than the rows read.
# Python workers get long texts a few MB at a time, not 10,000 at a time.
RUNTIME_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": str(16 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(8 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
}

# Stored bytes of the tables for each partition a shuffle starts from; adaptive execution merges those up to the advisory size.
TABLE_BYTES_PER_PARTITION = 2 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_local_roots: dict[str, str] = {}


def tune(spark: SparkSession) -> None:
    """Apply the runtime settings."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def scale_shuffles(spark: SparkSession, folder: str) -> None:
    """Let shuffles start from as many partitions as the tables of a folder ask for.

    With a fixed number of partitions a task's share grows with the tables.
    Where they are small, the session's own number stays.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    stored = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    wanted = -(-stored // TABLE_BYTES_PER_PARTITION)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    else:
        spark.conf.unset(INITIAL_PARTITIONS)


def local_session(app: str = "lakeops", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **RUNTIME_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder that every executor can reach, from ``spark.checkpoint.dir``.

    A temporary folder stands in for it only on a local master, where driver
    and executors are the same process.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="lakeops-")
    return _local_roots[sc.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in this application's part of it; no two calls return the same one."""
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def application_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_root(spark)}/lakeops-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once no result is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, *, path: str | None = None, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The returned frame has a one-step lineage, keeps column pruning, and does
    not depend on any executor staying alive.
    """
    spark = df.sparkSession
    target = path or fresh_path(spark, name)
    df.write.mode("overwrite").parquet(target, compression=compression)
    return spark.read.schema(df.schema).parquet(target)
