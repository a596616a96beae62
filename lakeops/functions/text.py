"""Text jobs over whole documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def extract_links(df: DataFrame, col: str, *, pattern: str, groups: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per match of ``pattern``, with its place and its captured groups."""
    found = [F.regexp_extract_all(F.col(col), F.lit(pattern), F.lit(i + 1)) for i in range(len(groups))]
    zipped = F.arrays_zip(*[f.alias(g) for f, g in zip(found, groups)])
    rows = df.select(*keep, F.posexplode(zipped).alias("position", "_m"))
    fields = rows.schema["_m"].dataType.names
    return rows.select(*keep, "position", *[F.col("_m")[f].alias(g) for f, g in zip(fields, groups)])


def strip_markup(df: DataFrame, col: str, *, name: str = "plain") -> DataFrame:
    """Tags removed and lines joined by single blanks."""
    return df.withColumn(name, F.trim(F.regexp_replace(F.regexp_replace(F.col(col), r"<[^>]+>", ""), r"\s*\n\s*", " ")))


def pattern_hits_with_context(df: DataFrame, col: str, *, phrase: str, keep: Sequence[str], before: int = 3) -> DataFrame:
    """Lines that hold a phrase, each with the lines just before it.

    The lines of a document are an array in its own row, so the context is a slice of it.
    """
    lines = df.select(*keep, F.split(F.col(col), "\n").alias("_lines"))
    hits = lines.select(*keep, "_lines", F.posexplode("_lines").alias("line_number", "line"))
    hits = hits.where(F.contains(F.lower("line"), F.lit(phrase.lower())))
    start = F.greatest(F.col("line_number") - before, F.lit(0))
    context = F.array_join(F.slice("_lines", start + 1, F.col("line_number") - start), "\n")
    return hits.select(*keep, "line_number", "line", context.alias("context"))


def pair_counts_in_lookback(df: DataFrame, a: str, b: str, *, ts: str, days: int, as_of: str) -> DataFrame:
    """Rows per pair in the last ``days`` days before ``as_of``."""
    end = F.lit(as_of).cast("date")
    day = F.to_date(ts)
    recent = df.where((day > F.date_sub(end, days)) & (day <= end))
    return recent.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))
