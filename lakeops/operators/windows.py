"""Window results built from running blocks and aggregates, so that no group has to fit in one task."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.ordered import (
    BLOCK, KINDS, Running, add_carry, crossing, join_back, numbered, ranked, running, sort_keys, to_blocks,
)
from lakeops.session import materialise


def window_apply(df: DataFrame, *, partition: Sequence[str], order: Sequence[str], func: str, name: str,
                 value: str | Column | None = None, descending: Sequence[str] = ()) -> DataFrame:
    """One window column.

    ``func`` is row_number, rank, dense_rank, or one of count, sum, min, max,
    last, which run up to the current row with an ``order`` and cover the
    whole partition without one.
    """
    if func == "row_number":
        return numbered(df, keys=partition, order=order, name=name, descending=descending)
    if func in ("rank", "dense_rank"):
        return ranked(df, keys=partition, order=order, name=name, dense=func == "dense_rank", descending=descending)
    if func not in KINDS:
        raise ValueError(f"unknown window function {func}")
    if order:
        return running(df, keys=partition, order=order, outputs=[Running(name, func, value)], descending=descending)
    fn = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[func]
    return join_back(df, df.groupBy(*partition).agg(fn(value if value is not None else F.lit(1)).alias(name)), partition)


def surrogate_key(df: DataFrame, *, order: Sequence[str], start=0, name: str) -> DataFrame:
    """Dense numbers above ``start`` in the order of the natural key; ``start`` may be a scalar sub-query."""
    first = start if isinstance(start, Column) else F.lit(start)
    return numbered(df, order=order, name=name).withColumn(name, (F.col(name) + first).cast("bigint"))


def dense_surrogate(df: DataFrame, cols: Sequence[str], *, name: str) -> DataFrame:
    """The same key for the same values: distinct values are numbered and joined back."""
    return ranked(df, order=list(cols), name=name, dense=True)


def week_rank_desc(df: DataFrame, *, week: str, name: str) -> DataFrame:
    """1 for the newest week. The distinct weeks are few (52 a year), so one task ranks them."""
    weeks = df.select(week).distinct()
    numbers = weeks.select(week, F.dense_rank().over(Window.orderBy(F.col(week).desc())).alias(name))
    return df.join(numbers, week)


def rank_percent(df: DataFrame, *, partition: Sequence[str], entity: Sequence[str], measure: Column | str, name: str = "rank_percent") -> DataFrame:
    """Dense rank of each entity's total, largest first, over the highest rank of its partition."""
    totals = df.groupBy(*partition, *entity).agg(F.sum(measure).alias("total"))
    places = ranked(totals, keys=partition, order=["total"], name="place", dense=True, descending=["total"])
    last = places.groupBy(*partition).agg(F.max("place").alias("_last"))
    return join_back(places, last, partition).withColumn(name, F.col("place").cast("double") / F.col("_last")).drop("_last")


def cumulative_share(df: DataFrame, *, partition: Sequence[str], measure: str, tie_break: Sequence[str],
                     name: str = "cumulative_share") -> DataFrame:
    """Running sum, largest first, over the partition total (Pareto curve)."""
    summed = running(df, keys=partition, order=[measure, *tie_break], descending=[measure],
                     outputs=[Running("_run", "sum", measure)])
    total = df.groupBy(*partition).agg(F.sum(measure).alias("_total"))
    return join_back(summed, total, partition).withColumn(
        name, F.col("_run").cast("double") / F.col("_total").cast("double")).drop("_run", "_total")


def window_total(df: DataFrame, *, partition: Sequence[str], measure: Column | str, name: str) -> DataFrame:
    """The partition's sum beside each row."""
    return join_back(df, df.groupBy(*partition).agg(F.sum(measure).alias(name)), partition)


def window_max_within(df: DataFrame, *, partition: Sequence[str], measure: Column | str, name: str) -> DataFrame:
    """The partition's maximum beside each row."""
    return join_back(df, df.groupBy(*partition).agg(F.max(measure).alias(name)), partition)


def validity_from_observations(df: DataFrame, *, attrs: Sequence[str], date: str) -> DataFrame:
    """First and last day an identical set of attributes was seen; 1900-01-01 and 9999-12-31 where undated."""
    return df.groupBy(*attrs).agg(
        F.coalesce(F.min(F.to_date(date)), F.lit("1900-01-01").cast("date")).alias("valid_from"),
        F.coalesce(F.max(F.to_date(date)), F.lit("9999-12-31").cast("date")).alias("valid_to"))


def top_n_others(df: DataFrame, *, partition: Sequence[str], name: str, measure: Column | str, n: int = 10,
                 other: str = "Others", label: str = "name_with_others") -> DataFrame:
    """The name where its total ranks in the first ``n`` (dense) of its partition, else ``other``.

    Only totals are ranked, and each task keeps its own best ranks before the shuffle.
    """
    totals = df.groupBy(*partition, name).agg(F.sum(measure).alias("_total"))
    place = F.dense_rank().over(Window.partitionBy(*partition).orderBy(F.col("_total").desc()))
    best = totals.select(*partition, name, place.alias("_place")).where(F.col("_place") <= n)
    best = best.select(*partition, name, F.lit(True).alias("_best"))
    return join_back(df, best, [*partition, name]).withColumn(
        label, F.when(F.col("_best"), F.col(name)).otherwise(other)).drop("_best")


def fill_forward_global(df: DataFrame, col: str, *, order: Sequence[str]) -> DataFrame:
    """The last non-null value so far in one global order."""
    return running(df, keys=[], order=order, outputs=[Running(col, "last", col)]).select(*df.columns)


def fill_forward_group(df: DataFrame, col: str, *, keys: Sequence[str], order: Sequence[str], fmt: str | None = None) -> DataFrame:
    """The last non-null value so far per group; with ``fmt`` the first order column is a date text."""
    if fmt:
        df2 = df.withColumn("_when", F.to_date(F.col(order[0]), fmt))
        return running(df2, keys=keys, order=["_when", *order[1:]], outputs=[Running(col, "last", col)]).select(*df.columns)
    return running(df, keys=keys, order=order, outputs=[Running(col, "last", col)]).select(*df.columns)


def _dated(df: DataFrame, order: str, fmt: str | None) -> DataFrame:
    return df.withColumn("_when", F.to_date(F.col(order), fmt) if fmt else F.col(order))


def ytd_running_sum(df: DataFrame, *, keys: Sequence[str], order: Sequence[str], measure: Column | str, name: str,
                    fmt: str | None = None) -> DataFrame:
    """Sum from the start of the year, per group; the first order column is the date."""
    staged = _dated(df, order[0], fmt).withColumn("_year", F.year("_when"))
    summed = running(staged, keys=[*keys, "_year"], order=["_when", *order[1:]], outputs=[Running(name, "sum", measure)])
    return summed.drop("_when", "_year")


def in_out_running_count(df: DataFrame, *, order: Sequence[str], value: str, in_name: str, out_name: str,
                         keys: Sequence[str] = (), fmt: str | None = None) -> DataFrame:
    """Running counts of entries (value above 0) and exits (value below 0)."""
    staged = _dated(df, order[0], fmt)
    v = F.col(value)
    counted = running(staged, keys=keys, order=["_when", *order[1:]], outputs=[
        Running(in_name, "sum", F.when(v > 0, 1).otherwise(0)),
        Running(out_name, "sum", F.when(v < 0, 1).otherwise(0))])
    return counted.drop("_when")


def running_streak(df: DataFrame, *, keys: Sequence[str], date: str, name: str = "days_in_state") -> DataFrame:
    """Length so far of the run of consecutive days of each key.

    Days are made distinct first, so a key has at most one row per calendar day.
    """
    days = df.select(*keys, F.to_date(date).alias(date)).distinct()
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(date))
    island = days.withColumn("_island", F.date_sub(F.col(date), nth))
    run = Window.partitionBy(*keys, "_island").orderBy(date)
    return island.withColumn(name, F.row_number().over(run)).drop("_island")


@dataclass(frozen=True)
class Level:
    """A record type that opens a key: the key is the parent's key followed by ``parts``."""

    name: str
    record: str
    parts: tuple[str, ...]
    parent: str | None = None


def _keys_in_order(df: DataFrame, *, record_type: str, levels: Sequence[Level], plain: set[str], keys: Sequence[str]) -> DataFrame:
    """The keys opened so far in each block, for rows that already lie in order: the state goes from row to row, nothing is shuffled.

    Texts stay in Arrow arrays: a batch makes the keys that its records open, and each row takes the number of its newest one.
    """
    names = [lv.name for lv in levels]
    parts = list(dict.fromkeys(c for lv in levels for c in lv.parts))
    # Plain values only, so that a task needs nothing of this package.
    specs = [(lv.record, [parts.index(c) for c in lv.parts], names.index(lv.parent) if lv.parent else None, lv.name in plain) for lv in levels]
    n_ids = len(keys) + 1

    @F.arrow_udf(", ".join(f"lacks_{i} tinyint, text_{i} string" for i in range(len(levels))))
    def opened(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        def taken(texts: pa.Array, at: np.ndarray) -> pa.Array:
            return texts.take(pa.array(at, mask=at < 0))

        fields = [f for i in range(len(specs)) for f in (f"lacks_{i}", f"text_{i}")]
        block = None
        # Of each level, the key open at the end of the last batch: -1 is none, 0 a complete one, above that the number of the level it lacks.
        state = [(-1, None)] * len(specs)
        for ids_kind_parts in batches:
            ids, kind, cols = ids_kind_parts[:n_ids], ids_kind_parts[n_ids], [c.cast(pa.string()) for c in ids_kind_parts[n_ids + 1:]]
            n = len(kind)
            if n == 0:
                yield pa.StructArray.from_arrays([pa.array([], t) for _ in specs for t in (pa.int8(), pa.string())], names=fields)
                continue
            starts = np.zeros(n, dtype=bool)
            starts[0] = block != tuple(c[0].as_py() for c in ids)
            for c in ids:
                here, above = c.slice(1), c.slice(0, n - 1)
                other = pc.and_not(pc.fill_null(pc.not_equal(here, above), True), pc.and_(here.is_null(), above.is_null()))
                starts[1:] |= other.to_numpy(zero_copy_only=False)
            start = np.maximum.accumulate(np.where(starts, np.arange(n), -1))  # -1: the block began in an earlier batch
            out: list[pa.Array] = []
            found: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
            for i, (record, used, parent, bare) in enumerate(specs):
                mine = np.flatnonzero(pc.fill_null(pc.equal(kind, record), False).to_numpy(zero_copy_only=False))
                own = [cols[c].take(pa.array(mine)) for c in used]
                lacks = np.zeros(len(mine), dtype=np.int8)
                if bare:
                    text = own[0]
                else:
                    text = pc.binary_join_element_wise(*([record] if parent is not None else []), *own, "", null_handling="skip")
                if parent is not None:
                    up_lacks, up_texts, up_at = found[parent]
                    at = up_at[mine]
                    lacks = np.where(at < 0, parent + 1, up_lacks[at]).astype(np.int8)
                    text = pc.binary_join_element_wise(taken(up_texts, at), text, "", null_handling="skip")
                # The key carried into the batch is number 0, those opened here follow.
                lacks = np.concatenate([np.array([state[i][0]], dtype=np.int8), lacks])
                texts = pa.concat_arrays([pa.array([state[i][1]], pa.string()), text])
                last = np.zeros(n, dtype=np.int64)
                last[mine] = np.arange(1, len(mine) + 1)
                last = np.maximum.accumulate(last)
                row = np.concatenate([np.array([-1]), mine])[last]
                at = np.where(row >= start, last, -1)
                if state[i][0] < 0:
                    at[at == 0] = -1
                out += [pa.array(np.where(at < 0, np.int8(-1), lacks[at]), pa.int8()), taken(texts, at)]
                found.append((lacks, texts, at))
                state[i] = (int(lacks[at[-1]]), texts[at[-1]].as_py()) if at[-1] >= 0 else (-1, None)
            block = tuple(c[n - 1].as_py() for c in ids)
            yield pa.StructArray.from_arrays(out, names=fields)

    keyed = df.withColumn("_k", opened.asNondeterministic()(*keys, BLOCK, record_type, *[F.col(c).cast("string") for c in parts]))
    found = [F.col(f"_k.{c}_{i}").alias(f"_{c}_{n}") for i, n in enumerate(names) for c in ("lacks", "text")]
    return keyed.select(*df.columns, *found)


def propagate_parent_keys(df: DataFrame, *, record_type: str, levels: Sequence[Level], file_col: str, position_col: str,
                          carried: Mapping[str, tuple[str, str]] | None = None, block: Column | None = None) -> DataFrame:
    """Give every record of a flat file the keys of the nearest records above it.

    Levels are listed parents first. ``carried`` adds plain values,
    ``{name: (record, column)}``, such as the business date of a header.
    Records before the first header of their file get null keys.

    Files are cut into blocks, and a block may start in
    the middle of a transaction. There a key opened in the block is kept with
    the number of the ancestor it still lacks, and is completed by that
    ancestor's carry, so one pass over the file is enough.

    Rows just read from files lie in order already. There ``block`` numbers, per file, the pieces that
    tasks read (``files.split_start``): the keys are found while reading, without a shuffle or a
    stored copy, and a second, narrow read of the files finds the carries of those cut into several pieces.
    """
    levels = [*levels, *[Level(n, r, (c,)) for n, (r, c) in (carried or {}).items()]]
    keys = [file_col]
    rows = to_blocks(df, keys, [position_col]) if block is None else df.withColumn(BLOCK, block)
    inside = Window.partitionBy(BLOCK, *keys).orderBy(*sort_keys([position_col])).rowsBetween(Window.unboundedPreceding, 0)
    plain = set((carried or {}).keys())
    depth: dict[str, int] = {}
    for lv in levels:
        depth[lv.name] = depth[lv.parent] + 1 if lv.parent else 0
    number = {lv.name: F.lit(i).cast("tinyint") for i, lv in enumerate(levels, 1)}

    def opened(lv: Level) -> Column:
        if lv.name in plain:
            own = F.col(lv.parts[0])
        else:
            own = F.concat_ws("", *([F.col(record_type)] if lv.parent else []), *lv.parts)
        if lv.parent is None:
            return F.struct(F.lit(None).cast("tinyint").alias("lacks"), own.alias("text"))
        up = F.col(f"_l_{lv.parent}")
        return F.struct(F.when(up.isNull(), number[lv.parent]).otherwise(up["lacks"]).alias("lacks"),
                        F.concat(F.coalesce(up["text"], F.lit("")), own).alias("text"))

    if block is None:
        # Levels of one depth do not need each other, so one window pass serves all of them.
        local = rows
        for d in range(max(depth.values()) + 1):
            same = [lv for lv in levels if depth[lv.name] == d]
            local = local.select("*", *[F.when(F.col(record_type) == lv.record, opened(lv)).alias(f"_o_{lv.name}") for lv in same])
            local = local.select("*", *[F.last(f"_o_{lv.name}", ignorenulls=True).over(inside).alias(f"_l_{lv.name}") for lv in same])
        local = materialise(local, name="keyed")
        seen = local.select("*", *[F.col(f"_o_{lv.name}").alias(f"_n_{lv.name}") for lv in levels])
        local = local.select("*", *[F.when(F.col(f"_l_{lv.name}").isNull(), F.lit(-1)).otherwise(F.coalesce(F.col(f"_l_{lv.name}")["lacks"], F.lit(0))).alias(f"_lacks_{lv.name}") for lv in levels],
                             *[F.col(f"_l_{lv.name}")["text"].alias(f"_text_{lv.name}") for lv in levels])
    else:
        found = dict(record_type=record_type, levels=levels, plain=plain, keys=keys)
        local = _keys_in_order(rows, **found)
        used = dict.fromkeys([*keys, position_col, BLOCK, record_type, *[c for lv in levels for c in lv.parts]])
        newest = lambda n: F.struct(F.when(F.col(f"_lacks_{n}") > 0, F.col(f"_lacks_{n}")).alias("lacks"), F.col(f"_text_{n}").alias("text"))
        seen = _keys_in_order(rows.select(*used), **found)
        seen = seen.select("*", *[F.when(F.col(f"_lacks_{lv.name}") >= 0, newest(lv.name)).alias(f"_n_{lv.name}") for lv in levels])

    ends = [F.max_by(f"_n_{lv.name}", F.when(F.col(f"_n_{lv.name}").isNotNull(), F.col(position_col))).alias(f"_e_{lv.name}") for lv in levels]
    carry = crossing(seen.groupBy(*keys, BLOCK).agg(*ends), keys)
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)

    def complete(key: Column, known: Sequence[str]) -> Column:
        text = key["text"]
        out = F.when(key["lacks"].isNull(), text)
        for ancestor in known:
            out = out.when(key["lacks"] == number[ancestor], F.concat(F.col(f"_c_{ancestor}"), text))
        return out

    done: list[str] = []
    for lv in levels:
        resolved = complete(F.col(f"_e_{lv.name}"), done)
        carry = carry.withColumn(f"_r_{lv.name}", resolved)
        carry = carry.withColumn(f"_c_{lv.name}", F.last(f"_r_{lv.name}", ignorenulls=True).over(before))
        done.append(lv.name)
    # One array holds the carries: a choice among them for each level would make code too long for the JVM to compile.
    joined = add_carry(local, carry.withColumn("_c", F.array(*[f"_c_{lv.name}" for lv in levels])), keys, ["_c"])
    outs = []
    for i, lv in enumerate(levels):
        lacks, text = F.col(f"_lacks_{lv.name}"), F.col(f"_text_{lv.name}")
        # A level opened before its block, or nowhere, takes the carry; one opened here is completed.
        outs.append(F.coalesce(F.when(lacks == 0, text), F.concat(F.get("_c", lacks - 1), text), F.get("_c", F.lit(i))).alias(lv.name))
    return joined.select(*df.columns, *outs)
