"""Reading the rows of some ids without shuffling the others, and giving disk back between steps."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.common import materialise

#: Bits of the table of wanted ids: 2048 bitmaps of 4 KB, 8 MB at most, whatever the number of ids.
BITS = 1 << 26


def _marked(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_likely``: whether a bitmap of hashed keys has the key. The bitmap goes to the scan of the rows and has a fixed size."""
    place = F.pmod(F.xxhash64(key), F.lit(BITS)) + 1
    bits = keys.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
    bits = materialise(bits, name="wanted-bits")
    at = F.bitmap_bit_position(F.col("_place"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    placed = rows.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number(F.col("_place")))
    return placed.join(F.broadcast(bits), "_bucket", "left").withColumn("_likely", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)))


def likely_rows(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in ``keys`` (one column), and few others, before any shuffle. With very many keys the bitmap lets more through."""
    return _marked(rows, keys, key).where("_likely").select(*rows.columns)


def likely_and_other_rows(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Those rows, and all others, whose key is surely not in ``keys``."""
    marked = _marked(rows, keys, key)
    return marked.where("_likely").select(*rows.columns), marked.where("not _likely").select(*rows.columns)


def rows_of(rows: DataFrame, ids: DataFrame, id: str) -> DataFrame:
    """The rows whose id is in ``ids`` (one column, distinct); a shuffle carries little more than them."""
    ids = materialise(ids.where(F.col(id).isNotNull()).select(id), name="wanted-ids")
    # Not a semi join: Spark would move that below the bitmap, to all rows.
    return likely_rows(rows, ids, id).join(ids, id).select(*rows.columns)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps, which it does once the driver's garbage is collected. Worth a call after large stored steps only."""
    gc.collect()
    spark._jvm.System.gc()
