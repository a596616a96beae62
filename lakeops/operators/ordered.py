"""Running values over an order, without putting an unbounded group in one task.

A plain window puts each partition-by group (or, without one, the whole table)
in a single task. Here rows are range-partitioned on group and order columns,
whatever their number, so a large group is cut into consecutive blocks. Values
are computed inside each block, and a carry from the earlier blocks is added.
Only groups that cross a block boundary need a carry, and there are fewer of
those than blocks, so the carry table has at most two rows per block.

Block boundaries come from a sample and may differ between runs, so only types
whose sums do not depend on the order of addition can be summed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import materialise

BLOCK = "_block"
KINDS = ("count", "sum", "min", "max", "last")


@dataclass(frozen=True)
class Running:
    """One output column: ``kind`` is one of ``KINDS``; ``last`` is the last non-null value."""

    name: str
    kind: str
    value: Column | str | None = None


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sort_keys(order: Sequence[str], descending: Sequence[str] = ()) -> list[Column]:
    """Ascending with nulls first, or descending with nulls last."""
    return [F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_first() for c in order]


def to_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """Rows with the number of the consecutive block they fall in.

    Range boundaries come from a sample, so a second evaluation may cut
    elsewhere. A caller computes what it needs inside the blocks in the same
    job, stores the result with ``materialise``, and goes on from there.
    """
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *sort_keys(order, descending))
    return ranged.withColumn(BLOCK, F.spark_partition_id())


def crossing(per_block: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The (group, block) rows of the groups that cross a block boundary.

    Fewer groups than blocks cross a boundary, so both the list of groups and
    the result are bounded by the number of blocks.
    """
    if not keys:
        return per_block
    span = per_block.groupBy(*keys).agg(F.min(BLOCK).alias("_lo"), F.max(BLOCK).alias("_hi")).where("_lo < _hi")
    span = span.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
    return per_block.join(F.broadcast(span), [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys], "left_semi")


def add_carry(blocks: DataFrame, carry: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Put the carry columns of a (group, block) on its rows; null where nothing is carried."""
    small = carry.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col(BLOCK).alias("_c_block"), *names)
    on = [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys] + [F.col(BLOCK) == F.col("_c_block")]
    return blocks.join(F.broadcast(small), on, "left")


def running(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: Sequence[Running],
    descending: Sequence[str] = (),
) -> DataFrame:
    """Add running columns per ``keys`` in ``order``, up to and including the current row.

    ``order`` should end in a unique column: rows that tie on all of it cannot
    be told apart, and cannot be cut into blocks. ``last`` needs an ascending order.
    """
    keys, order = list(keys), list(order)
    if descending and any(o.kind == "last" for o in outputs):
        raise ValueError("a running 'last' needs an ascending order")
    plain = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    replaced = {o.name for o in outputs}
    staged = df.withColumns({f"_in_{o.name}": _col(o.value) if o.kind != "count" else F.lit(1) for o in outputs})
    inexact = [o.name for o in outputs if o.kind == "sum" and staged.schema[f"_in_{o.name}"].dataType.typeName() in ("double", "float")]
    if inexact:
        raise ValueError(f"a running sum of floating numbers depends on the order of addition, cast to a decimal: {inexact}")
    blocks = to_blocks(staged, keys, order, descending)

    inside = Window.partitionBy(BLOCK, *keys).orderBy(*sort_keys(order, descending))
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    position = F.struct(*order)
    local, totals, carries = [], [], []
    for o in outputs:
        v, t = F.col(f"_in_{o.name}"), F.col(f"_tot_{o.name}")
        if o.kind == "last":
            local.append(F.last(v, ignorenulls=True).over(inside).alias(f"_at_{o.name}"))
            totals.append(F.max_by(v, F.when(v.isNotNull(), position)).alias(f"_tot_{o.name}"))
            carries.append(F.last(t, ignorenulls=True).over(before).alias(f"_car_{o.name}"))
        else:
            local.append(plain[o.kind](v).over(inside).alias(f"_at_{o.name}"))
            totals.append(plain[o.kind](v).alias(f"_tot_{o.name}"))
            joiner = F.sum if o.kind == "count" else plain[o.kind]
            carries.append(joiner(t).over(before).alias(f"_car_{o.name}"))

    stored = materialise(blocks.select("*", *local), name="blocks")
    per_block = crossing(stored.groupBy(*keys, BLOCK).agg(*totals), keys)
    carry = per_block.select(*keys, BLOCK, *carries)
    joined = add_carry(stored, carry, keys, [f"_car_{o.name}" for o in outputs])
    result = []
    for o in outputs:
        at, car = F.col(f"_at_{o.name}"), F.col(f"_car_{o.name}")
        kind = joined.schema[f"_at_{o.name}"].dataType
        if o.kind == "last":
            value = F.coalesce(at, car)
        elif o.kind == "min":
            value = F.least(at, car)
        elif o.kind == "max":
            value = F.greatest(at, car)
        else:
            value = F.when(at.isNull(), car).otherwise(at + F.coalesce(car, F.lit(0)))
        result.append(value.cast(kind).alias(o.name))
    return joined.select(*[F.col(c) for c in df.columns if c not in replaced], *result)


def numbered(df: DataFrame, *, keys: Sequence[str] = (), order: Sequence[str], name: str,
             descending: Sequence[str] = ()) -> DataFrame:
    """``row_number`` per group, or over the whole table, in blocks."""
    return running(df, keys=keys, order=order, outputs=[Running(name, "count")], descending=descending)


def join_back(df: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of a one-row-per-key frame; null keys match null keys.

    A hot key is on the row side only, where adaptive execution splits it.
    """
    if not keys:
        return df.select("*", *[per_key.select(c).scalar().alias(c) for c in per_key.columns])
    small = per_key.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    joined = df.join(small, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left")
    return joined.drop(*[f"_k_{k}" for k in keys])


def ranked(df: DataFrame, *, keys: Sequence[str] = (), order: Sequence[str], name: str, dense: bool = False,
           descending: Sequence[str] = ()) -> DataFrame:
    """``rank`` or ``dense_rank`` per group.

    Ties are folded to one row with a count before the running step, and the
    rank is joined back.
    """
    folded = df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("_ties"))
    if dense:
        ranks = numbered(folded, keys=keys, order=order, name=name, descending=descending).drop("_ties")
    else:
        total = running(folded, keys=keys, order=order, outputs=[Running(name, "sum", "_ties")], descending=descending)
        ranks = total.withColumn(name, F.col(name) - F.col("_ties") + 1).drop("_ties")
    return join_back(df, ranks, [*keys, *order])
