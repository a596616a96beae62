"""Aggregations. All combine inside each task before the shuffle, so a hot group costs one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.clean import as_column


def agg_group(df: DataFrame, keys: Sequence, aggs: Sequence[Column]) -> DataFrame:
    """Group by with named aggregates."""
    return df.groupBy(*keys).agg(*aggs)


def agg_recipe(df: DataFrame, keys: Sequence[str], exprs: Sequence[str]) -> DataFrame:
    """Aggregates given as SQL texts."""
    return df.groupBy(*keys).agg(*[F.expr(e) for e in exprs])


def agg_count_distinct(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """Exact distinct counts, ``{name: column}``."""
    return df.groupBy(*keys).agg(*[F.count_distinct(F.col(c)).alias(n) for n, c in cols.items()])


def agg_conditional_sum(df: DataFrame, keys: Sequence[str], buckets: Mapping[str, tuple[Column | str, Column | str]]) -> DataFrame:
    """``{name: (condition, value)}``: sum of the value where the condition holds, else 0."""
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(as_column(c), as_column(v)).otherwise(F.lit(0))).alias(n) for n, (c, v) in buckets.items()])


def agg_conditional_distinct(df: DataFrame, keys: Sequence[str], col: str, bands: Mapping[str, Column | str]) -> DataFrame:
    """``{name: condition}``: distinct values of ``col`` where the condition holds.

    The frame is first reduced to one row of flags per key and value, so the
    distinct counts need no row expansion.
    """
    flags = df.groupBy(*keys, col).agg(*[F.max(F.coalesce(as_column(c), F.lit(False))).alias(n) for n, c in bands.items()])
    known = F.col(col).isNotNull()
    return flags.groupBy(*keys).agg(*[F.sum(F.when(F.col(n) & known, 1).otherwise(0)).alias(n) for n in bands])


def agg_having(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], having: str) -> DataFrame:
    """Groups that satisfy a condition on their aggregates."""
    return df.groupBy(*keys).agg(*aggs).where(having)


def agg_two_level(df: DataFrame, outer: Sequence[str], inner: Sequence[str], *, inner_aggs: Sequence[Column],
                  outer_aggs: Sequence[Column]) -> DataFrame:
    """Per (outer, inner) first, then per outer."""
    return df.groupBy(*outer, *inner).agg(*inner_aggs).groupBy(*outer).agg(*outer_aggs)


def agg_flags_max(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column | str], *, yes: str = "YES") -> DataFrame:
    """Many rows per id folded to one row of flags: ``yes`` or null."""
    return df.groupBy(*keys).agg(*[F.max(F.when(as_column(c), yes)).alias(n) for n, c in flags.items()])


def ratio_percent(num: Column, den: Column) -> Column:
    """``100 * num / den`` rounded half up to two decimals, as decimal(5,2); null for a zero denominator."""
    share = F.lit(100).cast("decimal(3,0)") * num.cast("decimal(18,4)") / F.nullif(den.cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)"))
    return F.round(share, 2).cast("decimal(5,2)")


def agg_ratio_percent(df: DataFrame, keys: Sequence[str], num: Column | str, den: Column | str, *, name: str = "percent") -> DataFrame:
    """Percentage of two aggregates per group."""
    return (df.groupBy(*keys).agg(as_column(num).alias("_num"), as_column(den).alias("_den"))
            .withColumn(name, ratio_percent(F.col("_num"), F.col("_den"))).drop("_num", "_den"))


def agg_min_date_per_entity(df: DataFrame, keys: Sequence, date: str, *, name: str = "first_date") -> DataFrame:
    """First day per entity."""
    return df.groupBy(*keys).agg(F.min(F.to_date(date)).alias(name))


def agg_latest_per_key(df: DataFrame, keys: Sequence[str], order: str, *, ties: str = "keep") -> DataFrame:
    """Rows with the newest ``order`` value per key; ``ties="one"`` keeps a single row."""
    if ties == "one":
        rest = [c for c in df.columns if c not in keys]
        picked = df.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("_r"))
        return picked.select(*keys, "_r.*").select(*df.columns)
    newest = df.groupBy(*keys).agg(F.max(order).alias(order))
    return df.join(newest, [*keys, order], "left_semi")


def agg_extreme_then_detail(df: DataFrame, keys: Sequence[str], value: str, carry: Sequence[str], *, how: str = "max") -> DataFrame:
    """The largest (or smallest) value per key and the distinct other columns seen with it."""
    fn = F.max if how == "max" else F.min
    extreme = df.groupBy(*keys).agg(fn(value).alias(value))
    return df.join(extreme, [*keys, value], "left_semi").select(*keys, value, *carry).distinct()


def agg_total_vs_part(df: DataFrame, total_keys: Sequence[str], part_keys: Sequence[str],
                      aggs: Mapping[str, Column]) -> DataFrame:
    """Sums per part next to the sums of the whole, ``{name: value}``.

    The whole is added up from the parts, not from the rows again.
    """
    parts = df.groupBy(*total_keys, *part_keys).agg(*[F.sum(v).alias(n) for n, v in aggs.items()])
    whole = parts.groupBy(*total_keys).agg(*[F.sum(n).alias(f"total_{n}") for n in aggs])
    return parts.join(whole, list(total_keys)) if total_keys else parts.select(
        "*", *[whole.select(f"total_{n}").scalar().alias(f"total_{n}") for n in aggs])


def agg_rolling_periods(df: DataFrame, periods: Sequence[tuple[str, int, int]], *, rank: str, keys: Sequence[str],
                        aggs: Mapping[str, Column]) -> DataFrame:
    """Sums over several, possibly overlapping, rank windows ``(label, from, to)``.

    One pass over the rows: they are added up per rank, and only these
    weekly sums are repeated for the windows they fall in.
    """
    weekly = df.groupBy(*keys, rank).agg(*[F.sum(v).alias(n) for n, v in aggs.items()])
    spread = weekly.select("*", F.explode(_inside(periods, rank)).alias("_p")).withColumn("time_period", F.col("_p.label"))
    return spread.groupBy("time_period", *keys).agg(*[F.sum(n).alias(n) for n in aggs])


def agg_rolling_distinct(df: DataFrame, periods: Sequence[tuple[str, int, int]], *, rank: str, keys: Sequence[str], entities: Mapping[str, str]) -> DataFrame:
    """Exact numbers of distinct entities over several, possibly overlapping, rank windows ``(label, from, to)``.

    ``entities`` maps output names to columns of whole numbers above 0, best dense ones
    (surrogate keys). One pass over the rows makes a bitmap per key, week and
    32,768 entities, combined before the shuffle; a period unites the bitmaps of
    its weeks, so rows are not repeated for the periods they fall in. Nulls are
    not counted; a period in which a key has only nulls counts 0.
    """
    numbers = F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).cast("bigint").alias("id")) for i, c in enumerate(entities.values())])
    flat = df.select(*keys, rank, F.explode(numbers).alias("_e")).select(*keys, rank, "_e.which", "_e.id")
    flat = flat.withColumn("_slot", F.bitmap_bucket_number("id"))
    weekly = flat.groupBy(*keys, rank, "which", "_slot").agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("_bits"))
    spread = weekly.withColumn("_p", F.explode(_inside(periods, rank))).withColumn("time_period", F.col("_p.label"))
    united = spread.groupBy("time_period", *keys, "which", "_slot").agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"))
    counts = [F.sum(F.when(F.col("which") == i, F.col("_n")).otherwise(0)).alias(name) for i, name in enumerate(entities)]
    return united.groupBy("time_period", *keys).agg(*counts)


def _inside(periods: Sequence[tuple[str, int, int]], rank: str) -> Column:
    """The periods that hold a row's rank."""
    windows = F.array(*[F.struct(F.lit(l).alias("label"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for l, lo, hi in periods])
    return F.filter(windows, lambda p: F.col(rank).between(p["lo"], p["hi"]))


def agg_annualise(df: DataFrame, keys: Sequence[str], measure: Column, week: str, *, name: str = "annualised") -> DataFrame:
    """Sum per distinct week seen, times 52."""
    weekly = df.groupBy(*keys, week).agg(F.sum(measure).alias("_m"))
    return weekly.groupBy(*keys).agg((F.sum("_m").cast("double") / F.count(week) * 52).alias(name))


def agg_bands(df: DataFrame, keys: Sequence[str], col: str, edges: Sequence, *, entity: str, measure: Column,
              closed: bool = False) -> DataFrame:
    """Count of entities and sum per value band.

    Bands are below the first edge, between edges, and from the last edge on.
    Half-open by default; ``closed`` puts an inner edge value in both of its
    bands and takes only values above the last edge into the last band.
    """
    c = F.col(col)
    bands = [c < edges[0]]
    for lo, hi in zip(edges, edges[1:]):
        bands.append(c.between(lo, hi) if closed else (c >= lo) & (c < hi))
    bands.append(c > edges[-1] if closed else c >= edges[-1])
    per_entity = df.groupBy(*keys, entity).agg(
        *[F.max(F.coalesce(b, F.lit(False))).alias(f"_in{i}") for i, b in enumerate(bands)],
        *[F.sum(F.when(b, measure)).alias(f"_m{i}") for i, b in enumerate(bands)])
    return per_entity.groupBy(*keys).agg(
        *[F.sum(F.col(f"_in{i}").cast("bigint")).alias(f"band_{i + 1}_count") for i in range(len(bands))],
        *[F.coalesce(F.sum(f"_m{i}"), F.lit(0)).alias(f"band_{i + 1}_value") for i in range(len(bands))])


def agg_bridge(df: DataFrame, keys: Sequence[str], this: Column, last: Column, *, kind: str, base: str = "LY",
               name: str = "amount") -> DataFrame:
    """Waterfall: the change per ``kind`` and one base row with last year's amount, per key."""
    sums = df.groupBy(*keys, kind).agg(F.sum(this).alias("_t"), F.sum(last).alias("_l"))
    steps = sums.select(*keys, kind, (F.coalesce("_t", F.lit(0)) - F.coalesce("_l", F.lit(0))).alias(name))
    start = sums.groupBy(*keys).agg(F.coalesce(F.sum("_l"), F.lit(0)).alias(name))
    return steps.unionByName(start.select(*keys, F.lit(base).alias(kind), name))


def agg_distribution(df: DataFrame, keys: Sequence[str], distinct_col: str, *, name: str = "distribution") -> DataFrame:
    """Distinct places per product and period."""
    return df.groupBy(*keys).agg(F.count_distinct(distinct_col).alias(name))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``select distinct``."""
    return df.select(*cols).distinct()


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates removed."""
    return df.dropDuplicates()


def dedupe_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, descending: bool = False) -> DataFrame:
    """One row per key: the first by ``order``, the other columns breaking ties.

    A minimum over row structs, which combines before the shuffle, instead of
    a sorted group.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    picked = df.groupBy(*keys).agg((F.max(row) if descending else F.min(row)).alias("_r"))
    return picked.select(*keys, "_r.*").select(*df.columns)


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot: str, values: Sequence, agg: Column) -> DataFrame:
    """Pivot with declared values, so that no extra job looks for them."""
    return df.groupBy(*keys).pivot(pivot, list(values)).agg(agg)
