"""Set operations, sorting and extremes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all_rows(*dfs: DataFrame) -> DataFrame:
    """``UNION ALL`` by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct_rows(*dfs: DataFrame) -> DataFrame:
    """``UNION``: duplicates removed."""
    return union_all_rows(*dfs).distinct()


def union_padded(*dfs: DataFrame, distinct: bool = False) -> DataFrame:
    """Union of unlike record types, missing columns as nulls."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    return out.distinct() if distinct else out


def union_recipe(*dfs: DataFrame) -> DataFrame:
    """Union of named tables by position, duplicates kept."""
    return reduce(lambda a, b: a.union(b), dfs)


def intersect_recipe(*dfs: DataFrame) -> DataFrame:
    """Rows in every table, once each."""
    return reduce(lambda a, b: a.intersect(b), dfs)


def difference_recipe(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of the first table not in the second, once each."""
    return a.subtract(b)


def frozen_baseline_union(df: DataFrame, baseline: DataFrame, *, period_col: str, period) -> DataFrame:
    """Fresh rows of all other periods and the stored rows of the period that never changes."""
    return df.where(~F.col(period_col).eqNullSafe(F.lit(period))).unionByName(baseline)


def order_by_recipe(df: DataFrame, exprs: Sequence[str]) -> DataFrame:
    """Sort by texts such as ``"a desc"``."""
    keys = []
    for e in exprs:
        col, _, way = e.strip().rpartition(" ")
        if col and way.lower() in ("asc", "desc"):
            keys.append(F.expr(col).desc() if way.lower() == "desc" else F.expr(col).asc())
        else:
            keys.append(F.expr(e))
    return df.orderBy(*keys)


def top_k(df: DataFrame, exprs: Sequence[str], k: int) -> DataFrame:
    """First ``k`` rows by an order; each task keeps only its own best ``k``."""
    return order_by_recipe(df, exprs).limit(k)


def max_value(df: DataFrame, col: str, *, default, name: str = "max_value") -> DataFrame:
    """One row with the largest value, or ``default``."""
    kind = df.schema[col].dataType
    return df.agg(F.coalesce(F.max(col), F.lit(default).cast(kind)).alias(name))


def scalar(df: DataFrame) -> Column:
    """The single value of a one-row, one-column frame, as a sub-query."""
    return df.scalar()
