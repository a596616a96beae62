"""File layout by several columns, so that a filter on any of them skips files and row groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a column's rank: so many ranges, as powers of two.
RANK_BITS = 6


def _number(df: DataFrame, name: str) -> Column:
    """A column as a number in its own order; texts go by their first 7 bytes."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("double")
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int").cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def _rank(number: Column, bounds: Sequence[float]) -> Column:
    """How many bounds are not above a number; 0 for null."""
    below = F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda b: b <= number) if bounds else F.array()
    return F.when(number.isNull(), 0).otherwise(F.size(below)).cast("long")


def interleaved(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """One number whose bits are taken from the ranks in turn, the highest ones first."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, rank in enumerate(ranks):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long")), b * len(ranks) + len(ranks) - 1 - i))
    return out


def by_layout(df: DataFrame, cols: Sequence[str], *, bits: int = RANK_BITS) -> DataFrame:
    """``df`` in an order that keeps rows near in every one of ``cols`` together; write it as it is.

    Each column's values are ranked by range bounds (approximate quantiles, one
    pass that returns a fixed number of bounds), the bits of the ranks are
    interleaved, and rows are range-partitioned and sorted by that number.
    Adaptive execution sets the number of partitions by bytes, so files fill
    evenly. Nulls come first. Only the order of rows changes.
    """
    if not cols or len(cols) * bits > 62:
        raise ValueError("between one column and as many as fit 62 bits")
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    numbers = {c: _number(df, c) for c in cols}
    bounds = df.agg(*[F.percentile_approx(n, shares, 10_000).alias(c) for c, n in numbers.items()]).first()
    ranks = [_rank(n, sorted(set(bounds[c] or []))) for c, n in numbers.items()]
    placed = df.withColumn("_layout", interleaved(ranks, bits))
    return placed.repartitionByRange("_layout", *cols).sortWithinPartitions("_layout", *cols).drop("_layout")
