"""Small helpers that several training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import fresh_path, materialise, tune

__all__ = ["WORD", "SPACES", "Tables", "crc_mod", "draw60", "fresh_path", "key_text", "materialise", "words_in"]

#: What separates words, as a pattern and as characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


class Tables:
    """Attribute access to the Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        tune(spark)
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def key_text(column: Column | str) -> Column:
    """An id as text; a null id counts as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.pmod(F.crc32(key_text(column).cast("binary")), F.lit(n))


def draw60(*parts: Column) -> Column:
    """60 uniform bits of the joined parts, as a long: the first 15 hex digits of their md5."""
    return F.conv(F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 15), 16, 10).cast("long")


def words_in(text: Column) -> Column:
    """Number of words in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
