"""Projection, cleaning and filtering."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What stands for "unknown" in text, code, amount and open-ended dates.
UNKNOWN_TEXT = "UNKNOWN"
UNKNOWN_CODE = -1
UNKNOWN_AMOUNT = "0.0000"
OPEN_START = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 11:59:59"


def as_column(c: Column | str) -> Column:
    """SQL text or a Column as a Column."""
    return F.expr(c) if isinstance(c, str) else c


def select_rename_cast(df: DataFrame, spec: Sequence[tuple[Column | str, str, str]]) -> DataFrame:
    """Project ``(expression, type, name)`` triples."""
    return df.select(*[as_column(c).cast(t).alias(n) for c, t, n in spec])


def conform_columns(df: DataFrame, pairs: Sequence[tuple[str, str]], *, dtype: str = "string") -> DataFrame:
    """Target columns in order from ``(source, target)`` pairs; an absent or blank source gives nulls."""
    have = set(df.columns)
    return df.select(*[(F.col(s) if s and s in have else F.lit(None)).cast(dtype).alias(t) for s, t in pairs])


def select_column_order(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the listed columns, in that order."""
    return df.select(*cols)


def rename_mapping(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns."""
    return df.withColumnsRenamed(dict(mapping))


def normalise_column_names(df: DataFrame) -> DataFrame:
    """Lower-case names with every run of other characters than letters and digits as one underscore."""
    names = [re.sub(r"[^0-9a-z]+", "_", c.strip().lower()).strip("_") or f"column_{i}" for i, c in enumerate(df.columns)]
    seen: dict[str, int] = {}
    unique = []
    for n in names:
        seen[n] = seen.get(n, 0) + 1
        unique.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return df.toDF(*unique)


def strip_name_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Remove a namespace or other leading text from column names."""
    return df.toDF(*[c.removeprefix(prefix) for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str, *, only: Sequence[str] | None = None) -> DataFrame:
    """Put ``prefix`` before all or only some column names."""
    chosen = df.columns if only is None else only
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in chosen})


def cast_all_string(df: DataFrame) -> DataFrame:
    """Every column as a string."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def constant_columns(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add literal columns."""
    return df.withColumns({n: F.lit(v) for n, v in values.items()})


def record_timestamp(df: DataFrame, *, run: int, name: str = "record_timestamp") -> DataFrame:
    """Stamp rows with the run number."""
    return df.withColumn(name, F.lit(run).cast("bigint"))


def audit_columns(df: DataFrame, *, as_of: str) -> DataFrame:
    """Creation time, and an update time that is still null."""
    return df.withColumns({
        "create_datetime": F.lit(as_of).cast("timestamp_ntz"),
        "update_datetime": F.lit(None).cast("timestamp_ntz"),
    })


def default_sentinels(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls by a value per column, keeping the column's type."""
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()})


def case_rules(rules: Sequence[tuple[Column | str, object]], default: object = None) -> Column:
    """First matching condition wins; values are SQL text wrapped in a Column, or literals."""
    out = None
    for cond, value in rules:
        out = F.when(as_column(cond), value) if out is None else out.when(as_column(cond), value)
    return out.otherwise(default)


def derived_case_columns(df: DataFrame, rules: Sequence[tuple[str, Sequence[tuple[Column | str, object]], object]]) -> DataFrame:
    """Add columns from ``(name, [(condition, value), …], default)``; later ones may use earlier ones."""
    for name, cases, default in rules:
        df = df.withColumn(name, case_rules(cases, default))
    return df


def keyword_classify(df: DataFrame, col: str, rules: Sequence[Mapping], *, default: str, name: str = "category") -> DataFrame:
    """Class of a text by keywords.

    A rule is ``{label, any, none?, codes?}``: it matches when the lower-case
    text contains one of ``any`` and none of ``none``, or when ``codes``, a
    ``(column, values)`` pair, holds. The first match wins.
    """
    text = F.lower(F.col(col))

    def one(rule: Mapping) -> Column:
        hit = reduce(lambda a, b: a | b, [text.contains(w) for w in rule.get("any", [])], F.lit(False))
        for w in rule.get("none", []):
            hit = hit & ~text.contains(w)
        if "codes" in rule:
            code_col, values = rule["codes"]
            hit = hit | F.col(code_col).isin(list(values))
        return hit

    return df.withColumn(name, case_rules([(one(r), r["label"]) for r in rules], default))


def drop_empty_rows(df: DataFrame, *, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which all (chosen) columns are null."""
    return df.na.drop("all", subset=list(subset) if subset else None)


def trim_whitespace(df: DataFrame, *, cols: Sequence[str] | None = None) -> DataFrame:
    """Trim string columns."""
    chosen = cols or [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    return df.withColumns({c: F.trim(F.col(c)) for c in chosen})


def filter_predicates(df: DataFrame, preds: Sequence[str], *, extra: str | None = None) -> DataFrame:
    """AND of SQL predicates and one given at run time."""
    conds = [F.expr(p) for p in [*preds, *([extra] if extra else [])]]
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def status_filter(df: DataFrame, col: str, *, exclude: Sequence[str]) -> DataFrame:
    """Exclude statuses whatever their case; a null status is dropped, as ``NOT IN`` does."""
    return df.where(~F.upper(F.col(col)).isin([s.upper() for s in exclude]))


def pair_not_in(df: DataFrame, a: str, b: str, pairs: Sequence[tuple]) -> DataFrame:
    """Rows whose pair is not listed; a pair with a null is kept."""
    listed = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b")) for x, y in pairs]
    here = F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    return df.where(~F.coalesce(reduce(lambda x, y: x | y, [here.eqNullSafe(p) for p in listed]), F.lit(False)))


def range_exclusions(df: DataFrame, col: str, ranges: Sequence[tuple]) -> DataFrame:
    """Rows outside all closed code ranges."""
    return df.where(reduce(lambda a, b: a & b, [~F.col(col).between(lo, hi) for lo, hi in ranges]))


def sql_step(spark: SparkSession, query: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Run SQL text over named frames, written ``{name}`` in the text."""
    return spark.sql(query, **frames)


def custom_rule_hook(df: DataFrame, rules: Sequence[tuple[Callable[..., DataFrame], Mapping]]) -> DataFrame:
    """Apply user functions ``fn(df, **params) -> df`` in order."""
    for fn, params in rules:
        df = df.transform(fn, **params)
    return df
