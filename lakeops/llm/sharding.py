"""Shards from a hierarchical weighted hash tree.

The tree has regions, racks and shards. A key descends level by level: every
child draws -ln(u) / weight, where u is a hash of the key and the child's path,
and the least draw wins. So a child is chosen in proportion to its weight, and
a changed weight moves keys only into or out of that child: all movement stays
within the subtrees whose weights change. A shard that comes later opens a
region of its own, so it takes keys only into itself.

Defined results
- a null id counts as the empty text; null text has size 16 and crc32 0.
- rows with one id go to one shard, whatever else they hold.
- slots count the rows of a shard from 0, without gaps, in the order of hash
  block, id, size and crc; equal rows get consecutive slots.
- an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import draw60, key_text, materialise

Tree = dict[str, dict[str, dict[str, float]]]


def shard_tree(shards: int, planned: int = 40, per_rack: int = 5, racks: int = 2) -> Tree:
    """Region to rack to shard to weight. The first ``planned`` shards fill racks of ``per_rack``, ``racks`` to a region; each later shard opens a region."""
    tree: Tree = {}
    for s in range(shards):
        region = s // (per_rack * racks) if s < planned else planned + s
        rack = s % (per_rack * racks) // per_rack if s < planned else 0
        tree.setdefault(f"r{region}", {}).setdefault(f"k{rack}", {})[str(s)] = 1.0
    return tree


def _children(tree: Tree) -> dict[str, list[tuple[str, float]]]:
    """Path of each inner node to its children and their weights."""
    out: dict[str, list[tuple[str, float]]] = {"": []}
    for region, racks in tree.items():
        out[""].append((region, sum(sum(leaf.values()) for leaf in racks.values())))
        out[f"/{region}"] = [(rack, sum(leaf.values())) for rack, leaf in racks.items()]
        out |= {f"/{region}/{rack}": list(leaf.items()) for rack, leaf in racks.items()}
    return out


def _draw(key: Column, path: Column):
    """The draw of a child below ``path``, with its name."""

    def drawn(child: Column) -> Column:
        unit = (draw60(key, F.lit("|"), path, F.lit("/"), child["name"]).cast("double") + F.lit(0.5)) / F.lit(float(2**60))
        return F.struct((-F.log(unit) / child["weight"]).alias("d"), child["name"].alias("name"))

    return drawn


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard (int) of a text key. The tree is a literal, as large as the number of shards."""
    nodes = _children(tree)
    levels = [[p for p in nodes if p.count("/") == depth] for depth in range(3)]
    path = F.lit("")
    for paths in levels:
        kids = F.create_map(*[x for p in paths for x in (F.lit(p), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in nodes[p]]))])
        path = F.concat(path, F.lit("/"), F.array_min(F.transform(F.element_at(kids, path), _draw(key, path)))["name"])
    return F.element_at(F.split(path, "/"), -1).cast("int")


def with_slots(rows: DataFrame, *, shard: str = "shard", order: tuple[str, ...] = ("doc_id", "size", "text_crc32"), block_rows: int = 10_000) -> DataFrame:
    """Add ``slot``: the place of each row in its shard, from 0, without gaps.

    Equal rows are counted first, so many copies of one row are one row here.
    The rest falls into hash blocks of about ``block_rows`` rows; counts by
    block give each block its first slot, and places are numbered inside a
    block only. So no task holds a whole shard.
    """
    counted = materialise(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")), name="shard-rows")
    total = counted.groupBy(shard).count().agg(F.max("count")).first()[0] or 0
    blocked = counted.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(-(-total // block_rows) or 1)))
    upto = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocked.groupBy(shard, "_block").agg(F.sum("_n").alias("_rows")).select(shard, "_block", F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(shard, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = blocked.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(blocks, [shard, "_block"])
    slot = F.explode(F.sequence(F.col("_first") + F.col("_before"), F.col("_first") + F.col("_before") + F.col("_n") - 1))
    return placed.withColumn("slot", slot).select(*rows.columns, "slot")


def shard_documents(docs: DataFrame, shards: int = 40, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``grown_shard`` and ``slot``."""
    key = key_text(id)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, shard_tree(shards, shards)).alias("shard"),
        shard_of(key, shard_tree(shards + 1, shards)).alias("grown_shard"),
    )
    return with_slots(rows, order=(id, "size", "text_crc32"))
