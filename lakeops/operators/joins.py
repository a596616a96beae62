"""Joins with explicit null, tie and validity rules.

No function broadcasts a side by hand: Spark broadcasts a side whose size it
knows to be small, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.clean import as_column


def join_star_inner(fact: DataFrame, dims: Sequence[tuple[DataFrame, object]]) -> DataFrame:
    """Chain of inner equi-joins; ``on`` is a column name, a list, or a condition."""
    for dim, on in dims:
        fact = fact.join(dim, on, "inner")
    return fact


def join_left_default(left: DataFrame, right: DataFrame, on, *, defaults: Mapping[str, object]) -> DataFrame:
    """Left join, then a default for nulls in the listed columns."""
    joined = left.join(right, on, "left")
    types = {f.name: f.dataType for f in joined.schema}
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()})


def join_full_coalesce_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join; each key is the first non-null of both sides."""
    return left.join(right, list(keys), "full")


def join_apply(left: DataFrame, right: DataFrame, *, on_sql: str, how: str, select_sql: Sequence[str] = ("*",)) -> DataFrame:
    """Join of a recipe: the sides are named ``l`` and ``r`` in the SQL texts.

    Spark shuffles the sides itself where the join needs it, and so can split a hot key.
    """
    return left.alias("l").join(right.alias("r"), F.expr(on_sql), how).selectExpr(*select_sql)


def join_scalar_params(df: DataFrame, one_row_df: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row, as scalar sub-queries (no join)."""
    return df.select("*", *[one_row_df.select(c).scalar().alias(c) for c in one_row_df.columns])


def cross_join_grid(entities: DataFrame, days: DataFrame, *, first: str = "first_day", last: str = "last_day",
                    name: str = "day", step: str = "1 day") -> DataFrame:
    """Every entity on every day, so that empty days appear.

    ``days`` has one row with the first and last day. The day list is an
    array built in each row and exploded, so nothing is joined or shuffled.
    """
    span = F.sequence(days.select(first).scalar(), days.select(last).scalar(), F.expr(f"interval {step}"))
    return entities.select("*", F.explode(span).alias(name))


def join_validity_half_open(fact: DataFrame, dim: DataFrame, *, on: Sequence[str], date: str, start: str, end: str,
                            how: str = "inner") -> DataFrame:
    """The version valid on a date: ``start <= date < end``.

    An equi-join on the key, the range being checked on its matches; a key
    has few versions, so matches per fact row stay few.
    """
    return _validity(fact, dim, on, how, lambda d, s, e: (s <= d) & (d < e), date, start, end)


def join_validity_closed(fact: DataFrame, dim: DataFrame, *, on: Sequence[str], date: str, start: str, end: str,
                         how: str = "inner") -> DataFrame:
    """``date BETWEEN start AND end``: on a shared boundary day both versions match."""
    return _validity(fact, dim, on, how, lambda d, s, e: d.between(s, e), date, start, end)


def _validity(fact, dim, on, how, test, date, start, end):
    renamed = dim.withColumnsRenamed({k: f"_d_{k}" for k in on})
    cond = [F.col(k) == F.col(f"_d_{k}") for k in on] + [test(F.col(date), F.col(start), F.col(end))]
    return fact.join(renamed, cond, how).drop(*[f"_d_{k}" for k in on])


def join_validity_bucketed(fact: DataFrame, dim: DataFrame, *, on: Sequence[str], date: str, start: str, end: str,
                           closed: bool = False, how: str = "inner") -> DataFrame:
    """The version valid on a date, for keys with very many versions.

    Time between the first and the last date of the facts is cut into buckets,
    per key about as many as it has versions, so the sum over keys is bounded
    by the versions. A version is placed in the buckets it covers, open ends
    clipped to the dates seen, and a fact meets the versions of its bucket only:
    an equi-join on key and bucket in place of one on the key alone, where a
    million facts would meet each of 100,000 versions. The rows are those of
    ``join_validity_half_open``, or of ``join_validity_closed`` if ``closed``.
    ``how`` is inner or left; null keys, dates and bounds match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a validity look-up is inner or left, not {how}")

    def number(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp"))

    seen = fact.agg(F.min(number(date)).alias("lo"), F.max(number(date)).alias("hi"))
    lo, hi = seen.select("lo").scalar(), seen.select("hi").scalar()
    keys = [f"_d_{k}" for k in on]
    met = dim.withColumnsRenamed(dict(zip(on, keys))).withColumns({"_from": F.greatest(number(start), lo), "_to": F.least(number(end), hi)})
    # Versions outside of the dates seen go; greatest and least would pass over a null bound.
    met = met.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col("_from") <= F.col("_to")) & (number(start) <= hi) & (number(end) >= lo))
    versions = met.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))

    def bucket(c: Column) -> Column:
        return F.floor((c - lo).cast("double") / (hi - lo + 1).cast("double") * F.col("_n")).cast("bigint")

    spread = met.join(versions, keys).withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_from")), bucket(F.col("_to"))))).drop("_from", "_to", "_n")
    placed = fact.join(versions, [F.col(k).eqNullSafe(F.col(d)) & F.col(k).isNotNull() for k, d in zip(on, keys)], "left").drop(*keys)
    placed = placed.withColumn("_bucket_of", bucket(number(date))).drop("_n")
    valid = F.col(date).between(F.col(start), F.col(end)) if closed else (F.col(start) <= F.col(date)) & (F.col(date) < F.col(end))
    same = [F.col(k) == F.col(d) for k, d in zip(on, keys)] + [F.col("_bucket_of") == F.col("_bucket"), valid]
    return placed.join(spread, same, how).drop(*keys, "_bucket", "_bucket_of")


def join_active_only(fact: DataFrame, dim: DataFrame, *, on, flag: str, value: str = "Y", how: str = "inner") -> DataFrame:
    """Join the current version only."""
    return fact.join(dim.where(F.col(flag) == value), on, how)


def join_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], *, how: str) -> DataFrame:
    """Equi-join in which null equals null."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    joined = left.join(renamed, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols], how)
    return joined.drop(*[f"_r_{c}" for c in cols])


def join_expression_keys(left: DataFrame, right: DataFrame, *, left_key: Column | str, right_key: Column | str, how: str) -> DataFrame:
    """Equi-join on computed keys (a date of a timestamp, a trimmed or built text)."""
    l = left.withColumn("_key", as_column(left_key))
    r = right.withColumn("_key", as_column(right_key))
    return l.join(r, "_key", how).drop("_key")


def join_branch_by_value(left: DataFrame, by_value: Mapping[str, DataFrame], *, on: Sequence[str], channel: str) -> DataFrame:
    """One look-up table per channel: united under a channel column and joined once."""
    both = None
    for value, lookup in by_value.items():
        part = lookup.withColumn(channel, F.lit(value))
        both = part if both is None else both.unionByName(part)
    return left.join(both, [*on, channel], "left")


def join_previous_day_self(df: DataFrame, *, keys: Sequence[str], date: str, counter: str) -> DataFrame:
    """Yesterday's counter of the same key plus one, or one where yesterday has no row."""
    prev = df.select(*keys, F.date_add(date, 1).alias(date), F.col(counter).alias("_prev"))
    return df.join(prev, [*keys, date], "left").withColumn(
        counter, (F.coalesce(F.col("_prev"), F.lit(0)) + 1).cast(df.schema[counter].dataType)).drop("_prev")


def join_latest_snapshot(df: DataFrame, snap: DataFrame, *, key: Sequence[str], by: str, few_keys: bool = False) -> DataFrame:
    """Rows of ``df`` that belong to the newest ``by`` value in ``snap`` per key.

    With ``few_keys`` the newest values go to all tasks: rows are not shuffled
    by so few values, which would put each snapshot in one task.
    """
    newest = snap.groupBy(*key).agg(F.max(by).alias(by))
    return df.join(F.broadcast(newest) if few_keys else newest, [*key, by], "left_semi")


def semi_join_in(df: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``IN (select …)``."""
    return df.join(other, list(cols), "left_semi")


def anti_join_not_in(df: DataFrame, other: DataFrame, col: str) -> DataFrame:
    """``NOT IN (select …)``: one null in the list empties the result, a null on the left is dropped.

    Written as an anti join on the non-null keys and two scalar facts about
    the list, so it is an ordinary hash or sort-merge join at any size. An
    empty list keeps every row.
    """
    facts = other.agg(F.count(F.lit(1)).alias("n"), F.count(F.col(col)).alias("known"))
    n, known = facts.select("n").scalar(), facts.select("known").scalar()
    kept = df.where((n == 0) | ((n == known) & F.col(col).isNotNull()))
    return kept.join(other.where(F.col(col).isNotNull()).select(col), col, "left_anti").select(*df.columns)


def anti_join_not_exists(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """``NOT EXISTS`` with equality."""
    return df.join(other, on, "left_anti")


def anti_left_join_null(new: DataFrame, old: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of ``new`` without an identical row in ``old`` on all tracked columns, null equal to null."""
    renamed = old.select(*[F.col(c).alias(f"_o_{c}") for c in cols])
    return new.join(renamed, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in cols], "left_anti")


def lookup_map(df: DataFrame, map_df: DataFrame, *, key: str, value: str, name: str, map_key: str | None = None) -> DataFrame:
    """A two-column look-up: the value of ``key``, null where it is unknown."""
    pairs = map_df.select(F.col(map_key or key).alias("_mk"), F.col(value).alias("_mv"))
    return df.join(pairs, F.col(key) == F.col("_mk"), "left").select(*df.columns, F.col("_mv").alias(name))


def status_cascade_lookup(df: DataFrame, sources: Sequence[tuple[str, DataFrame]], *, key: Sequence[str], value: str,
                          default, label: str, default_label: str = "Default") -> DataFrame:
    """The value of the first source that knows the key, with the name of that source.

    Sources are tried in order; ``default`` is used where none knows the key.
    """
    out, found = df, []
    for i, (source, frame) in enumerate(sources):
        looked = frame.select(*key, F.col(value).alias(f"_v{i}"), F.lit(True).alias(f"_k{i}"))
        out = out.join(looked, list(key), "left")
        found.append((source, f"_k{i}", f"_v{i}"))
    kind = sources[0][1].schema[value].dataType if sources else T.DoubleType()
    price, name = None, None
    for source, known, v in found:
        price = F.when(F.col(known), F.col(v)) if price is None else price.when(F.col(known), F.col(v))
        name = F.when(F.col(known), source) if name is None else name.when(F.col(known), source)
    return out.select(*df.columns, price.otherwise(F.lit(default).cast(kind)).alias(value),
                      name.otherwise(default_label).alias(label))
