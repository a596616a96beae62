"""Mix sources to target weights with hash-threshold histograms.

Each row has a fixed draw of 60 bits from its id. Sizes are summed by source
and by the leading bits of the draw; the running sums tell in which bucket a
source's budget ends; only that bucket is summed again by its next bits, until
a single draw value is left. Rows whose draw lies below the threshold get one
more copy than the others. Nothing is sorted by row, and a larger budget takes
every row that a smaller one takes (the thresholds are nested).

Defined results
- null ids count as the empty text, so they share one draw; rows with one id
  and one source share a draw and are taken alike.
- null sources are a source of their own, the last by code point.
- rows without words have size 0 and are never taken; a source or a table
  whose sizes are all 0 has target 0; an empty table gives an empty result.
- at the end of a budget the last draw value is taken if that lands nearer to
  the target, so a source misses its target by half the size of its boundary
  rows at most.
- columns of the input that clash with a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import draw60, key_text, materialise, words_in

DRAW_BITS = 60
LEVEL_BITS = 12


def source_targets(totals: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Sources by code point, null last, weigh ``weights``, repeating. They share
    ``share`` times all sizes by weight, none above ``most`` times its size: the
    sources that reach this stop are those with the least size per weight, so
    running sums in that order give the share per weight of the others. The
    windows see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = totals.withColumn("_turn", (F.row_number().over(by_name) - 1) % len(weights)).withColumn(
        "_weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.col("_turn") + 1).cast("long")
    )
    by_room = Window.orderBy((F.col("source_size") / F.col("_weight")).asc(), F.col("source").asc_nulls_last())
    before, everything = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stopped = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(most))
    left = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    rate = (F.sum("source_size").over(everything) * F.lit(float(share)) - stopped) / left
    full = F.col("source_size") * F.lit(float(most))
    ruled = weighed.withColumn("_rate", rate).withColumn("_place", F.row_number().over(by_room)).withColumn("_full", F.col("_rate") * F.col("_weight") >= full)
    # All sources from the first one that stays below its stop share its rate.
    shared = F.min(F.when(~F.col("_full"), F.struct("_place", "_rate"))).over(everything)["_rate"]
    target = F.when(F.col("_full") | shared.isNull(), full).otherwise(F.least(full, shared * F.col("_weight")))
    return ruled.select("source", "source_size", target.cast("double").alias("target"))


def source_thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Add ``_epochs`` and ``_below`` to the targets: each row is taken ``_epochs`` times, and once more if its draw is less than ``_below``.

    ``sized`` holds ``source``, ``size`` and ``_draw``. Level by level the
    histogram of the boundary buckets is written as a small table, so that the
    next level joins one row per source.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    epochs = F.floor(ratio + F.lit(1e-12)).cast("long")
    cut = targets.select("source", "source_size", "target", epochs.alias("_epochs"), F.lit(0).cast("long").alias("_bucket"))
    cut = cut.withColumn("_rest", F.greatest(F.lit(0.0), F.col("target") - F.col("_epochs") * F.col("source_size")))
    cut, rows = materialise(cut, name="mix-targets"), sized
    for shift in range(DRAW_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        if shift < DRAW_BITS - LEVEL_BITS:
            inside = cut.select(F.col("source").alias("_s"), "_bucket")
            rows = rows.join(inside, F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("_draw", shift + LEVEL_BITS) == F.col("_bucket"))).drop("_s", "_bucket")
            if shift == DRAW_BITS - 2 * LEVEL_BITS:
                rows = materialise(rows, name="mix-boundary")
        sums = rows.groupBy("source", F.shiftright("_draw", shift).alias("_digit")).agg(F.sum("size").alias("_sum"))
        upto = Window.partitionBy("source").orderBy("_digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("_upto", F.sum("_sum").over(upto)).withColumnRenamed("source", "_s")
        ended = F.min(F.when(F.col("_upto") > F.col("_rest"), F.struct("_digit", "_sum", "_upto"))).alias("_end")
        keys = ["source", "source_size", "target", "_epochs", "_rest"]
        found = cut.drop("_bucket", "_sum").join(sums, F.col("source").eqNullSafe(F.col("_s")), "left").groupBy(*keys).agg(ended)
        cut = found.select(*keys[:4], F.coalesce("_end._digit", F.lit(0)).cast("long").alias("_bucket"), (F.col("_rest") - F.coalesce(F.col("_end._upto") - F.col("_end._sum"), F.lit(0))).alias("_rest"), F.coalesce("_end._sum", F.lit(0)).alias("_sum"))
        cut = materialise(cut, name="mix-cut")
    takes_last = (F.col("_rest") > 0) & (F.col("_rest") * 2 >= F.col("_sum"))
    return cut.select("source", "source_size", "target", "_epochs", (F.col("_bucket") + takes_last.cast("long")).alias("_below"))


def mix(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` (size times copies).

    ``size`` defaults to the words of ``text``. The scan computes sizes and
    draws once into a narrow table; the rows themselves are joined to one row
    per source, which Spark broadcasts only while that table is small.
    """
    size = words_in(F.col("text")) if size is None else size
    sized = docs.select(F.col(source).alias("source"), size.alias("size"), draw60(key_text(id), F.lit("|"), key_text(source)).alias("_draw"))
    sized = materialise(sized, name="mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cuts = source_thresholds(sized, source_targets(totals, weights, share, most)).withColumnRenamed("source", "_s")
    rows = docs.drop("size", "source_size", "target", "taken").withColumns({"size": size, "_draw": draw60(key_text(id), F.lit("|"), key_text(source))})
    taken = F.col("size") * (F.col("_epochs") + (F.col("_draw") < F.col("_below")).cast("long"))
    return rows.join(cuts, F.col(source).eqNullSafe(F.col("_s"))).withColumn("taken", taken).drop("_s", "_draw", "_epochs", "_below")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows that the mix takes, each as often as it is taken, with the columns of ``docs``.

    A row that is taken twice appears twice. Rows without words carry nothing
    to weigh and are left out.
    """
    copies = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(F.lit(0)).cast("int")
    out = mix(docs, **options)
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*docs.columns)
