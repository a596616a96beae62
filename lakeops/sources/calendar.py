"""The calendar dimension and the financial periods read from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The date column every period lookup starts from, and Spark's day numbers (1 = Sunday).
WEEK_START = {"SUN": 1, "MON": 2, "TUE": 3, "WED": 4, "THU": 5, "FRI": 6, "SAT": 7}


def date_bounds(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row with the first and last day, from literals."""
    return spark.range(1).select(F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day"))


def calendar_dimension(bounds: DataFrame, *, as_of: str, fin_year_start_month: int = 9, week_start: str = "SUN") -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of the one-row frame ``bounds``.

    The financial year starts on the first ``week_start`` day on or after the
    first of ``fin_year_start_month`` and is named after the calendar year it
    ends in. Financial months are the 4-4-5 week groups, the last one taking
    any week 53.
    """
    first_dow = WEEK_START[week_start]

    def fin_start(year: Column) -> Column:
        anchor = F.make_date(year, F.lit(fin_year_start_month), F.lit(1))
        return F.date_add(anchor, F.pmod(F.lit(first_dow) - F.dayofweek(anchor), F.lit(7)))

    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_value"))
    d = F.col("date_value")
    days = days.select(
        "date_value",
        F.year(d).alias("_y"),
        F.date_sub(d, F.pmod(F.dayofweek(d) - F.lit(first_dow), F.lit(7))).alias("week_commencing_date"),
    )
    opened = fin_start(F.col("_y")) <= d
    days = days.select(
        "*",
        F.when(opened, fin_start(F.col("_y"))).otherwise(fin_start(F.col("_y") - 1)).alias("start_fin_year"),
        F.when(opened, F.date_sub(fin_start(F.col("_y") + 1), 1)).otherwise(F.date_sub(fin_start(F.col("_y")), 1)).alias("end_fin_year"),
        F.when(opened, F.col("_y") + 1).otherwise(F.col("_y")).alias("_fy"),
    )
    fin_days = F.date_diff("end_fin_year", "start_fin_year") + 1
    fin_week = F.floor(F.date_diff(d, F.col("start_fin_year")) / 7).cast("int") + 1
    days = days.select("*", fin_days.alias("days_in_fin_year"), fin_week.alias("financial_week_number"))
    quarter = F.least(F.floor((F.col("financial_week_number") - 1) / 13).cast("int") + 1, F.lit(4))
    week_in_quarter = F.col("financial_week_number") - (quarter - 1) * 13
    fin_month = (quarter - 1) * 3 + F.when(week_in_quarter <= 4, 1).when(week_in_quarter <= 8, 2).otherwise(3)
    last_of_year = F.make_date(F.col("_y"), F.lit(12), F.lit(31))
    midnight = F.col("date_value").cast("timestamp_ntz")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        (F.date_diff(d, F.lit("1970-01-01").cast("date")) + 2440588).alias("julian_day"),
        midnight.alias("date_time_start"),
        (midnight + F.expr("interval 23 hours 59 minutes 59 seconds")).alias("date_time_end"),
        d.alias("date_value"),
        (F.pmod(F.dayofweek(d) - F.lit(first_dow), F.lit(7)) + 1).cast("int").alias("day_of_week_number"),
        F.date_format(d, "EEEE").alias("day_of_week_desc"),
        F.date_format(d, "E").alias("day_of_week_sdesc"),
        F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0).alias("weekend_flag"),
        F.dayofmonth(d).alias("day_of_month_number"),
        F.date_format(d, "MM").alias("month_value"),
        F.date_format(d, "MMMM").alias("month_desc"),
        F.date_format(d, "MMM").alias("month_sdesc"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.dayofmonth(F.last_day(d)).alias("days_in_month"),
        F.when(d == F.last_day(d), 1).otherwise(0).alias("last_day_of_month_flag"),
        F.dayofyear(d).alias("day_of_year_number"),
        F.date_format(d, "yyyy").alias("year_value"),
        F.concat(F.lit("Year "), F.date_format(d, "yyyy")).alias("year_desc"),
        F.date_format(d, "yy").alias("year_sdesc"),
        F.trunc(d, "year").alias("year_start_date"),
        last_of_year.alias("year_end_date"),
        F.when(d == last_of_year, 1).otherwise(0).alias("last_day_of_year_flag"),
        F.dayofyear(last_of_year).alias("days_in_year"),
        "start_fin_year",
        "end_fin_year",
        F.floor(F.col("days_in_fin_year") / 7).cast("int").alias("weeks_in_fin_year"),
        "financial_week_number",
        "days_in_fin_year",
        F.col("_fy").cast("string").alias("financial_year"),
        fin_month.cast("int").alias("financial_month_number"),
        quarter.cast("int").alias("financial_quarter_number"),
        "week_commencing_date",
        F.weekofyear("week_commencing_date").alias("calendar_week"),
        F.lit(as_of).cast("timestamp_ntz").alias("create_datetime"),
        F.lit(None).cast("timestamp_ntz").alias("update_datetime"),
    )


def previous_fin_week(cal: DataFrame, *, as_of: str) -> DataFrame:
    """The last completed financial week: one row, fin_week and fin_year.

    It is the week before the one of ``as_of``; in week 1 it is the week of the day seven days earlier.
    """
    today = cal.where(F.col("date_value") == F.lit(as_of).cast("date"))
    week_ago = cal.where(F.col("date_value") == F.date_sub(F.lit(as_of).cast("date"), 7))
    in_first = F.col("financial_week_number") == 1
    return today.select(
        F.when(in_first, week_ago.select("financial_week_number").scalar())
        .otherwise(F.col("financial_week_number") - 1).alias("fin_week"),
        F.when(in_first, week_ago.select("financial_year").scalar()).otherwise(F.col("financial_year")).alias("fin_year"),
    )


def previous_month(cal: DataFrame, *, as_of: str) -> DataFrame:
    """First and last day and number of the month before ``as_of``."""
    month = F.add_months(F.trunc(F.lit(as_of).cast("date"), "month"), -1)
    return cal.where(F.col("month_start_date") == month).select(
        F.col("month_start_date").alias("month_start"), F.col("month_end_date").alias("month_end"),
        F.date_format("month_start_date", "yyyyMM").cast("int").alias("month_key")).distinct()


def week_date_range(cal: DataFrame, fin_week: DataFrame, *, shift_days: int = 0, end_time: bool = False) -> DataFrame:
    """Start and end of one financial week, moved by ``shift_days``; ``end_time`` ends it on the last second."""
    week = cal.where((F.col("financial_week_number") == fin_week.select("fin_week").scalar())
                     & (F.col("financial_year") == fin_week.select("fin_year").scalar()))
    if end_time:
        shift = F.expr(f"interval {shift_days} days")
        return week.agg((F.min("date_time_start") + shift).alias("week_start"), (F.max("date_time_end") + shift).alias("week_end"))
    return week.agg(F.date_add(F.min("date_value"), shift_days).alias("week_start"),
                    F.date_add(F.max("date_value"), shift_days).alias("week_end"))


def between_days(col: str | Column, first, last) -> Column:
    """Rows from the start of the first day to the end of the last.

    The column itself is compared, not a date made from it, so the predicate
    reaches the scan and skips files and row groups.
    """
    c = F.col(col) if isinstance(col, str) else col
    return (c >= F.lit(first).cast("date")) & (c < F.date_add(F.lit(last).cast("date"), 1))


def load_mode_filter(col: str | Column, *, mode: str, cal: DataFrame | None = None, as_of: str | None = None,
                     date_from: str | None = None, date_to: str | None = None, period: str = "fin_week",
                     shift_days: int = 0) -> Column:
    """The date predicate of a load: ``I`` takes the last completed period, ``H`` the given dates.

    In mode ``I`` one row of the calendar, the period's two ends, is read here,
    so that the predicate holds plain dates.
    """
    if mode == "H":
        return between_days(col, date_from, date_to)
    if mode != "I":
        raise ValueError(f"load mode must be I or H, not {mode}")
    if period == "month":
        span = previous_month(cal, as_of=as_of).select("month_start", "month_end").first()
    else:
        span = week_date_range(cal, previous_fin_week(cal, as_of=as_of), shift_days=shift_days).first()
    if span is None or span[0] is None:
        return F.lit(False)
    return between_days(col, span[0], span[1])


def week_anchor_calendar(cal: DataFrame, *, minus_one_years: tuple[int, ...] = ()) -> DataFrame:
    """Monday of each day and a week number corrected at the year end.

    ISO week 1 in December counts as week 53 of the old year, and the years
    listed in ``minus_one_years`` run one week behind.
    """
    d = F.col("date_value")
    monday = F.date_sub(d, F.pmod(F.dayofweek(d) - 2, F.lit(7)))
    iso = F.weekofyear(d)
    fixed = F.when((iso == 1) & (F.month(d) == 12), F.lit(53)).otherwise(iso)
    if minus_one_years:
        fixed = F.when(F.year(d).isin(*minus_one_years), fixed - 1).otherwise(fixed)
    return cal.select("date_key", "date_value", monday.alias("week_anchor"), fixed.cast("int").alias("week_number"))
