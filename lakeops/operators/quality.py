"""Standardising rules, row checks, quarantine split and quality reports."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.ordered import join_back
from lakeops.session import materialise

CHECK = "dq_check_"
FINAL = "dq_final"
ERRORS = "dq_errors"

# The quality dimensions of a report.
DIMENSIONS = ("Conformity", "Integrity", "Consistency", "Accuracy")

# Named patterns for the regex check.
REGEX_LIBRARY = {
    "DIGITS": r"^[0-9]+$",
    "ALPHA": r"^[A-Za-z]+$",
    "ALPHANUMERIC": r"^[A-Za-z0-9]+$",
    "ISO_DATE": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "EMAIL": r"^[^@\s]+@[^@\s]+\.[^@\s]+$",
    "DECIMAL": r"^-?[0-9]+(\.[0-9]+)?$",
}

PREDEFINED: dict[str, Callable[[Column], Column]] = {
    "trim": F.trim,
    "upper": F.upper,
    "lower": F.lower,
    "title": F.initcap,
    "digits_only": lambda c: F.regexp_replace(c, "[^0-9]", ""),
    "null_if_blank": lambda c: F.when(F.trim(c) != "", c),
}


def _names(cols: str | Sequence[str]) -> list[str]:
    return [c.strip() for c in cols.split(",")] if isinstance(cols, str) else list(cols)


def rule_predefined(df: DataFrame, rules: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """``{rule: "c1,c2"}``: standardise columns by a named rule, rules in order."""
    for rule, cols in rules.items():
        df = df.withColumns({c: PREDEFINED[rule](F.col(c)) for c in _names(cols)})
    return df


def rule_expression(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """``{type, columns, expression, value}``.

    ``regex`` replaces matches of the expression; ``value`` sets the value
    where the SQL condition holds, ``{c}`` standing for the column.
    """
    for r in rules:
        for c in _names(r["columns"]):
            if r["type"] == "regex":
                df = df.withColumn(c, F.regexp_replace(F.col(c), r["expression"], r["value"]))
            elif r["type"] == "value":
                kind = df.schema[c].dataType
                cond = F.expr(r["expression"].replace("{c}", f"`{c}`"))
                df = df.withColumn(c, F.when(cond, F.lit(r["value"]).cast(kind)).otherwise(F.col(c)))
            else:
                raise ValueError(f"unknown expression rule {r['type']}")
    return df


def _rule_split(df: DataFrame, r: Mapping) -> DataFrame:
    parts = F.split(F.col(r["column"]), re.escape(r["separator"]))
    out = df.withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(r["into"])})
    return out.drop(r["column"]) if r.get("drop") else out


def _rule_concat(df: DataFrame, r: Mapping) -> DataFrame:
    out = df.withColumn(r["into"], F.concat_ws(r.get("separator", ""), *_names(r["columns"])))
    return out.drop(*_names(r["columns"])) if r.get("drop") else out


def _rule_lookup(df: DataFrame, r: Mapping) -> DataFrame:
    found = r["frame"].select(F.col(r["key"]).alias(r["column"]), F.col(r["value"]).alias(r["into"]))
    return df.join(found, r["column"], "left")


COMPLEX = {"split": _rule_split, "concat": _rule_concat, "lookup": _rule_lookup}


def rule_complex(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Rules over several columns, which may add or drop columns: split, concat, lookup."""
    return reduce(lambda d, r: COMPLEX[r["type"]](d, r), rules, df)


def validate_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Differences to an expected schema as rows: missing, extra or other type.

    ``affected_rows`` counts the rows that a difference touches: all rows for
    a missing column, rows with a value for an extra one, and rows whose value
    does not convert for another type. One pass counts all of them.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in expected}
    diffs = [(n, "missing", w, None, F.lit(True)) for n, w in want.items() if n not in have]
    diffs += [(n, "extra", None, h, F.col(n).isNotNull()) for n, h in have.items() if n not in want]
    diffs += [(n, "type", w, have[n], F.col(n).isNotNull() & F.col(n).cast("string").try_cast(w).isNull())
              for n, w in want.items() if n in have and have[n] != w]
    if not diffs:
        return df.sparkSession.createDataFrame([], "column string, difference string, expected string, found string, affected_rows bigint")
    counts = df.agg(*[F.count(F.when(touched, 1)).alias(f"_d{i}") for i, (*_, touched) in enumerate(diffs)])
    rows = F.array(*[F.struct(
        F.lit(n).alias("column"), F.lit(kind).alias("difference"), F.lit(w).cast("string").alias("expected"),
        F.lit(h).cast("string").alias("found"), F.col(f"_d{i}").alias("affected_rows")) for i, (n, kind, w, h, _) in enumerate(diffs)])
    return counts.select(F.explode(rows).alias("_r")).select("_r.*")


def _check(r: Mapping) -> Column:
    c = F.col(r["column"]) if "column" in r else None
    kind = r["kind"]
    if kind == "regex":
        return c.cast("string").rlike(REGEX_LIBRARY.get(r["pattern"], r["pattern"]))
    if kind == "not_null":
        return c.isNotNull() & (F.trim(c.cast("string")) != "")
    if kind == "in_list":
        return c.isin(list(r["values"]))
    if kind == "range":
        return c.between(r["low"], r["high"])
    if kind == "length":
        return F.length(c.cast("string")).between(r.get("low", 0), r["high"])
    if kind == "type":
        return c.try_cast(r["type"]).isNotNull()
    if kind == "expression":
        return F.expr(r["expression"])
    raise ValueError(f"unknown check {kind}")


def dq_row_rules(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Add a 0/1 column per rule ``{name, kind, column, dimension, …}``; a null result fails.

    All plain checks are one projection. ``unique`` counts the key and joins
    the count back; ``reference`` joins the distinct reference values.
    """
    cols = df.columns
    for r in rules:
        if r["kind"] == "unique":
            keys = _names(r["column"])
            df = join_back(df, df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"_n_{r['name']}")), keys)
        elif r["kind"] == "reference":
            ref = r["frame"].select(F.col(r["key"]).alias(r["column"])).distinct().withColumn(f"_n_{r['name']}", F.lit(1))
            df = df.join(ref, r["column"], "left")
    checks = []
    for r in rules:
        if r["kind"] in ("unique", "reference"):
            ok = F.col(f"_n_{r['name']}") == 1
        else:
            ok = _check(r)
        checks.append(F.when(F.coalesce(ok, F.lit(False)), 1).otherwise(0).alias(f"{CHECK}{r['name']}"))
    return df.select(*cols, *checks)


def check_columns(df: DataFrame) -> list[str]:
    """The check columns of a frame."""
    return [c for c in df.columns if c.startswith(CHECK)]


def dq_final_flag(df: DataFrame) -> DataFrame:
    """1 where every check passed."""
    checks = check_columns(df)
    flag = F.least(*checks) if len(checks) > 1 else (F.col(checks[0]) if checks else F.lit(1))
    return df.withColumn(FINAL, flag)


def dq_error_text(df: DataFrame) -> DataFrame:
    """Names of the failed rules, comma separated."""
    failed = [F.when(F.col(c) == 0, c.removeprefix(CHECK)) for c in check_columns(df)]
    return df.withColumn(ERRORS, F.concat_ws(",", F.array_compact(F.array(*failed))))


def dq_split(df: DataFrame, *, enforce: bool, store: bool = True) -> tuple[DataFrame, DataFrame]:
    """Good and bad rows. Without ``enforce`` all rows go on, and the bad ones are still returned for counting.

    The checked frame is stored once, so the checks do not run for both halves.
    """
    checked = materialise(df, name="checked") if store else df
    bad = checked.where(F.col(FINAL) == 0)
    return (checked.where(F.col(FINAL) == 1) if enforce else checked), bad


def dq_rule_report(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Checked, failed and failed percent per rule, from one pass."""
    sums = df.agg(F.count(F.lit(1)).alias("checked"), *[
        F.sum(1 - F.col(f"{CHECK}{r['name']}")).alias(f"_f_{r['name']}") for r in rules])
    rows = F.array(*[F.struct(F.lit(r["name"]).alias("rule"), F.lit(r.get("dimension", DIMENSIONS[0])).alias("dimension"),
                              F.col(f"_f_{r['name']}").cast("bigint").alias("failed")) for r in rules])
    long = sums.select("checked", F.explode(rows).alias("_r")).select("_r.rule", "_r.dimension", "checked",
                                                                     F.coalesce("_r.failed", F.lit(0)).alias("failed"))
    return long.withColumn("failed_percent", _percent(F.col("failed"), F.col("checked")))


def _percent(part: Column, whole: Column) -> Column:
    share = F.lit(100).cast("decimal(3,0)") * part.cast("decimal(18,0)") / F.nullif(whole.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(share, 2).cast("decimal(5,2)")


def dq_dimensions(report: DataFrame) -> DataFrame:
    """Passed percent per quality dimension; 0 for a dimension without rules."""
    per = report.groupBy("dimension").agg(F.sum("checked").alias("checked"), F.sum("failed").alias("failed"))
    names = report.sparkSession.range(1).select(F.explode(F.array(*[F.lit(d) for d in DIMENSIONS])).alias("dimension"))
    joined = names.join(per, "dimension", "left")
    passed = _percent(F.col("checked") - F.col("failed"), F.col("checked"))
    return joined.select("dimension", F.coalesce("checked", F.lit(0)).alias("checked"), F.coalesce("failed", F.lit(0)).alias("failed"),
                         F.coalesce(passed, F.lit(0).cast("decimal(5,2)")).alias("passed_percent"))


def dq_counts(df: DataFrame) -> DataFrame:
    """Total, bad and good rows."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.coalesce(F.sum(1 - F.col(FINAL)), F.lit(0)).cast("bigint").alias("bad_rows"),
                  F.coalesce(F.sum(F.col(FINAL)), F.lit(0)).cast("bigint").alias("good_rows"))


def drop_helper_columns(df: DataFrame, *, pattern: str = "^dq_") -> DataFrame:
    """Remove internal columns by name pattern."""
    return df.drop(*[c for c in df.columns if re.search(pattern, c)])
