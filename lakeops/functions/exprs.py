"""Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast with nulls for texts that do not fit, and a column counting them per row."""
    failed = sum((F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), 1).otherwise(0) for c, t in types.items()), F.lit(0))
    return df.withColumn("cast_failures", failed).withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def pad_period_label(c: Column) -> Column:
    """``24P1`` to ``24P01``: the period number as two digits."""
    text = c.cast("string")
    return F.concat(F.substring(text, 1, 3), F.lpad(F.substring(text, 4, 2), 2, "0"))


def year_week_key(year: Column, week: Column) -> Column:
    """Year and two-digit week as one int."""
    return F.concat(year.cast("string"), F.lpad(week.cast("string"), 2, "0")).cast("int")


def store_number_from_name(c: Column, *, start: int = 9, length: int = 4) -> Column:
    """The number at a fixed place in a name, without leading zeros; null where it is not a number."""
    return F.ltrim(F.substring(c, start, length), F.lit("0")).try_cast("int")


def format_kpi(c: Column, style: str) -> Column:
    """A number as report text.

    Styles: ``millions`` 1.23m, ``pounds`` £1.23, ``percent`` 1% from 0.01,
    and the signed ``percent_change`` and ``pounds_change``, with negatives in brackets.
    """
    v = F.coalesce(c.cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)"))

    def text(value: Column, kind: str) -> Column:
        return value.cast(kind).cast("string")

    hundred, million = F.lit(100).cast("decimal(3,0)"), F.lit(1000000).cast("decimal(7,0)")
    if style == "millions":
        return F.concat(text(v / million, "decimal(18,2)"), F.lit("m"))
    if style == "pounds":
        return F.concat(F.lit("£"), text(v, "decimal(18,2)"))
    if style == "percent":
        return F.concat(text(v * hundred, "decimal(18,0)"), F.lit("%"))
    if style in ("percent_change", "points_change"):
        unit = "%" if style == "percent_change" else "%p"
        size = text(F.abs(v) * hundred, "decimal(18,1)")
        return F.when(v >= 0, F.concat(size, F.lit(unit))).otherwise(F.concat(F.lit("("), size, F.lit(f"{unit})")))
    if style == "pounds_change":
        size = text(F.abs(v), "decimal(18,2)")
        return F.when(v >= 0, F.concat(F.lit("£"), size)).otherwise(F.concat(F.lit("(£"), size, F.lit(")")))
    raise ValueError(f"unknown style {style}")


def date_key_int(c: Column) -> Column:
    """yyyyMMdd as an int."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def year_month_int(c: Column) -> Column:
    """Year and unpadded month run together, 20241 or 202311: for equality only, not for ordering."""
    return F.concat(F.year(c).cast("string"), F.month(c).cast("string")).cast("int")


def two_digit_year_prefix(c: Column, *, century: str = "20") -> Column:
    """yyMMdd text as a date."""
    return F.to_date(F.concat(F.lit(century), c.cast("string")), "yyyyMMdd")


def expiry_date(code: Column, stored: Column, stored_other: Column, produced: Column, received: Column, *,
                codes: Sequence[str], days: int = 180, other_days: int = 28) -> Column:
    """When a script runs out.

    Classes in ``codes`` use ``stored``, all others ``stored_other``: that date
    plus one day. Without it, the production date, else the receipt date, plus
    ``days`` for the listed classes and ``other_days`` for the others.
    """
    base = F.coalesce(produced, received)
    listed = F.coalesce(F.date_add(stored, 1), F.date_add(base, days))
    other = F.coalesce(F.date_add(stored_other, 1), F.date_add(base, other_days))
    return F.when(code.isin(list(codes)), listed).otherwise(other)


def week_bucket_label(c: Column, *, prefix: str) -> Column:
    """``prefix`` + yyyyMM, then the days of the Sunday and Saturday around ``c``."""
    sunday = F.date_sub(c.cast("date"), F.dayofweek(c) - 1)
    saturday = F.date_add(sunday, 6)
    return F.concat(F.lit(prefix), F.date_format(c, "yyyyMM"), F.date_format(sunday, "dd"), F.lit("_"),
                    F.date_format(saturday, "dd"))


def row_identity(df: DataFrame, cols: Sequence[str], *, name: str = "row_id") -> DataFrame:
    """An id from the business columns, the same on every run and retry."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]
    return df.withColumn(name, F.sha2(F.concat_ws("\u0001", *parts), 256))
