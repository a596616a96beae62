"""Jaccard join of documents on word n-grams with adaptive prefixes that must match more than once.

Sort every set by one global order, rare n-grams first. If x and y share o
elements, the first l of them lie within the first |x| - o + l of x. A link at
threshold t has o >= ceil(t |x|), so with prefixes of |x| - ceil(t |x|) + l(x)
elements, links share at least min(l(x), l(y)) of them. Each document picks its
own l: it lengthens the prefix while the estimated cost of candidates falls
faster than the cost of postings rises. A document of frequent n-grams so asks
for many shared ones, in the end for its whole set, where counting is verifying.

1. A table of fixed size counts n-grams by slot, over all documents. Slots that
   stand out give the order and the cost of frequent n-grams; the spread of the
   others tells how many documents an ordinary n-gram has. Any table gives the
   same result.
2. Equal sets are one class. Prefixes of classes become postings; n-grams of one
   class only are dropped.
3. The least class of a posting list is its hub. Classes that share much with one
   hub form a cluster, and a class is compared with the hub that it shares most
   with. Pairs across clusters come from short posting lists by counting. Links
   give components.
4. What is left are pairs of one cluster, and of long posting lists across
   clusters. Both are compared in blocks, but never the largest component (or
   cluster) with itself. So a group of near copies costs blocks of sets, not
   pairs, and only what joins two components comes out.

Every comparison asks for the shared prefix elements first and for whole sets
then, so the result is exact.

Defined results
- words: lower-case A-Z, separated by ASCII white space. Fewer words than an n-gram are one n-gram;
  null text and text without words have the empty set and link with nothing.
- n-grams and sets are equal if 64-bit hashes of them are.
- repeated ids are rows like others; a class takes part under its least id. Rows with a null id link with
  nothing and get a null component.
- an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import fresh_path, materialise
from lakeops.llm.near_dedup import _Hashes, components, shingle_sets
from lakeops.llm.wanted import drop_table, release_shuffles, rows_of

#: A link has NUMERATOR / DENOMINATOR of the union in common, at least.
NUMERATOR, DENOMINATOR = 80, 100
SLOT_BITS = 18
#: Cost of verifying an element of a candidate, in postings.
VERIFY = 1 / 16
#: Posting lists up to this length are joined with themselves; longer ones are compared in blocks.
SHORT_LIST = 64
BLOCK = 256
TEXTS_AT_ONCE = 500
TOKENS_AT_ONCE = 4096

U = np.uint64


def least_common(n: int) -> int:
    """Elements that a set of ``n`` shares with any other that it links with, at least."""
    return -(-NUMERATOR * n // DENOMINATOR)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Small batches with their texts' sets."""
    hashes = _Hashes()
    for batch in batches:
        for k in range(0, len(batch), TEXTS_AT_ONCE):
            part = batch.slice(k, TEXTS_AT_ONCE)
            yield part, shingle_sets(part.column("text").to_pylist(), hashes)


class Frequencies(NamedTuple):
    """Of n-grams by slot: ``levels``, about 2 log2 of the documents by which a slot stands out, and ``others``, the other documents of an ordinary n-gram."""

    levels: np.ndarray
    others: float


def frequencies(docs: DataFrame) -> Frequencies:
    """Count the n-grams of all documents by slot."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for _, sets in _texts(batches):
            total += np.bincount((np.concatenate(sets) >> U(64 - SLOT_BITS)).astype(np.int64), minlength=1 << SLOT_BITS)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(total[slots])], ["slot", "n"])

    found = docs.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(1 << SLOT_BITS)
    total[found["slot"].to_numpy(np.int64)] = found["n"]
    return estimated(total)


def estimated(total: np.ndarray) -> Frequencies:
    """Frequencies from documents counted by slot.

    If every n-gram of a slot had one document, counts would spread as wide as
    their mean; their variance grows with the sum of squared frequencies.
    """
    usual = float(np.median(total))
    out = np.maximum(0, total - usual - 5 * np.sqrt(usual) - 1)
    rest = total[out == 0]
    others = max(0.0, rest.var() / rest.mean() - 1) if rest.sum() else 0.0
    return Frequencies(np.rint(2 * np.log2(1 + out)).astype(np.uint8), others)


def ordered(elements: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorted set in global order, and the level of each element."""
    level = levels[(elements >> U(64 - SLOT_BITS)).astype(np.int64)]
    order = np.argsort(level, kind="stable")
    return elements[order], level[order]


def matches(level: np.ndarray, ordinary: float = 0.0) -> int:
    """How many prefix elements a set of these levels asks for: the least estimated cost among powers of two."""
    n = len(level)
    most = least_common(n)
    choices = np.unique(np.minimum(1 << np.arange(most.bit_length() + 1), most))
    length = n - most + choices
    others = np.cumsum(np.exp2(level / 2.0) - 1 + ordinary)[length - 1]
    return int(choices[np.argmin(length + others / choices * (1 + VERIFY * n))])


def described(docs: DataFrame, seen: Frequencies) -> DataFrame:
    """One row per row of ``id``, ``text``: ``id``, ``n``, class ``c`` (null if empty), ``ell``, ``first`` (prefix length at one match) and the prefix."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _texts(batches):
            prefixes, ells, firsts = [], [], []
            for s in sets:
                tokens, level = ordered(s, seen.levels)
                ell = matches(level, seen.others) if len(s) else 0
                first = len(s) - least_common(len(s)) + 1 if len(s) else 0
                prefixes.append(tokens[: first + ell - 1 if ell else 0])
                ells.append(ell)
                firsts.append(first)
            ends = np.cumsum([0, *map(len, prefixes)])
            values = np.concatenate([*prefixes, np.zeros(0, U)]).view(np.int64)
            columns = [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) for s in sets], pa.int64()), pa.array(ells, pa.int32()), pa.array(firsts, pa.int32()), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "c", "ell", "first", "prefix"])

    return docs.select("id", "text").mapInArrow(describe, "id long, n long, c long, ell int, first int, prefix array<long>")


def class_of(elements: np.ndarray) -> int | None:
    """64 bits of a set, as a signed number; None for the empty one."""
    return int(np.array([xxhash.xxh3_64_intdigest(elements.tobytes())], U).view(np.int64)[0]) if len(elements) else None


def whole_sets(docs: DataFrame, wanted: DataFrame, seen: Frequencies) -> DataFrame:
    """(``c``, ``n``, ``ell``, ``tokens``) of the wanted classes (``c``, ``rep``): their texts alone are read again."""

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _texts(batches):
            found = [(class_of(s), len(s), *ordered(s, seen.levels)) for s in sets if len(s)]
            columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([matches(f[3], seen.others) for f in found], pa.int32()), pa.array([f[2].tobytes() for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["c", "n", "ell", "tokens"])

    texts = rows_of(docs, wanted.select(F.col("rep").alias("id")).distinct(), "id")
    sets = texts.select("text").mapInArrow(to_sets, "c long, n long, ell int, tokens binary").join(wanted.select("c"), "c", "left_semi")
    return materialise(sets.dropDuplicates(["c"]), name="join-sets")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """(left, right) number of shared elements of sets."""
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(np.unique(a), np.unique(b), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float32)

    def spots(flat: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(both, flat)
        here = both[np.minimum(at, len(both) - 1)] == flat
        return np.repeat(np.arange(len(parts)), [len(p) for p in parts])[here], at[here]

    if len(both):
        (row_a, at_a), (row_b, at_b) = spots(a, left), spots(b, right)
        for k in range(0, len(both), TOKENS_AT_ONCE):
            x, y = (np.zeros((len(parts), TOKENS_AT_ONCE), np.float32) for parts in (left, right))
            for grid, row, at in ((x, row_a, at_a), (y, row_b, at_b)):
                here = (at >= k) & (at < k + TOKENS_AT_ONCE)
                grid[row[here], at[here] - k] = 1
            out += x @ y.T
    return out.astype(np.int64)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def links_of_group(c: np.ndarray, n: np.ndarray, ell: np.ndarray, side: np.ndarray, own: np.ndarray, label: np.ndarray, tokens: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join components within one group.

    Rows of side 0 meet those of side 1, rows of side 2 each other. Rows of one
    ``own`` or one ``label`` are not compared; labels that a link joins count as
    one from then on, so there are fewer links than rows.
    """
    within = bool((side == 2).any())
    left, right = (np.arange(len(c)),) * 2 if within else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    if not len(left) or not len(right):
        return []
    length = n - -(-NUMERATOR * n // DENOMINATOR) + ell
    may = (own[left][:, None] != own[right]) & (label[left][:, None] != label[right])
    may &= DENOMINATOR * np.minimum(n[left][:, None], n[right]) >= NUMERATOR * np.maximum(n[left][:, None], n[right])
    if within:
        may &= left[:, None] < right
    if not may.any():
        return []
    shared = shared_counts([tokens[i][: length[i]] for i in left], [tokens[j][: length[j]] for j in right])
    may &= shared >= np.minimum(ell[left][:, None], ell[right])
    a, b = np.nonzero(may)
    order = np.argsort(-shared[a, b], kind="stable")
    parent = {x: x for x in label.tolist()}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    found = []
    for p, q in zip(a[order].tolist(), b[order].tolist()):
        i, j = left[p], right[q]
        u, v = top(int(label[i])), top(int(label[j]))
        if u != v:
            common = int(shared[p, q]) if length[i] == n[i] and length[j] == n[j] else _common(tokens[i], tokens[j])
            if DENOMINATOR * common >= NUMERATOR * (int(n[i]) + int(n[j]) - common):
                parent[u] = v
                found.append((int(c[i]), int(c[j])))
    return found


def _linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of rows sorted by group; a group may span batches."""

    def links(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        column = {k: rows[k].to_numpy() for k in ("c", "n", "ell", "side", "own", "label")}
        tokens = [np.frombuffer(t, U) for t in rows["tokens"]]
        found = []
        for s, e in zip(starts, [*starts[1:], len(rows)]):
            found += links_of_group(*[v[s:e] for v in column.values()], tokens[s:e])
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if len(rows):
            key = rows[["g", "b1", "b2"]].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
            yield links(rows.iloc[: starts[-1]], starts[:-1])
            rest = rows.iloc[starts[-1] :]
    if rest is not None:
        yield links(rest, np.zeros(1, np.int64))


def linked(members: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Links within groups of members (``g``, ``b1``, ``b2``, ``side``, ``c``, ``own``, ``label``), which meet their sets."""
    rows = members.join(sets, "c").repartition("g", "b1", "b2").sortWithinPartitions("g", "b1", "b2")
    found = materialise(rows.select("g", "b1", "b2", "side", "c", "own", "label", "n", "ell", "tokens").mapInPandas(_linked, "a long, b long"), name=name)
    release_shuffles(members.sparkSession)
    return found


def star_members(edges: DataFrame) -> DataFrame:
    """Groups for pairs (``a``, ``b``): blocks of the other ends of each ``a``, which is in each block."""
    degree = edges.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_blocks"))
    rows = edges.join(degree, "a").withColumn("b1", F.pmod(F.xxhash64("b"), F.col("_blocks")))

    def end(c: str, side: int) -> DataFrame:
        return rows.select(F.col("a").alias("g"), "b1", F.lit(0).cast("long").alias("b2"), F.lit(side).alias("side"), F.col(c).alias("c"), F.lit(side).cast("long").alias("own"), F.col(c).alias("label"))

    return end("b", 1).unionByName(end("a", 0).distinct())


def block_members(rows: DataFrame) -> DataFrame:
    """Groups for rows (``g``, ``c``, ``own``, ``label``): the blocks of each ``g``, two by two, but those of its largest ``own`` with others only."""
    owns = rows.groupBy("g", "own").agg(F.count(F.lit(1)).alias("m"))
    per = owns.groupBy("g").agg(F.max_by("own", "m").alias("_major"), F.max("m").alias("_of_major"), F.sum("m").alias("_all"), F.count(F.lit(1)).alias("_owns"))
    per = per.where("_owns > 1").select("g", "_major", F.ceil((F.col("_all") - F.col("_of_major")) / BLOCK).alias("_minor_blocks"), F.ceil(F.col("_of_major") / BLOCK).alias("_major_blocks"))
    placed = rows.join(per, "g").withColumn("_minor", F.col("own") != F.col("_major"))
    placed = placed.withColumn("_block", F.pmod(F.xxhash64("c", "g"), F.when(F.col("_minor"), F.col("_minor_blocks")).otherwise(F.col("_major_blocks"))))
    first, count = F.lit(0).cast("long"), F.col("_minor_blocks")
    # Blocks are numbered through, those of the largest one last.
    number = F.when(F.col("_minor"), F.col("_block")).otherwise(count + F.col("_block"))
    others = F.when(F.col("_minor"), F.sequence(first, count + F.col("_major_blocks") - 1)).otherwise(F.sequence(first, count - 1))
    met = placed.withColumn("_number", number).withColumn("_other", F.explode(others))
    side = F.when(F.col("_number") == F.col("_other"), 2).when(F.col("_number") < F.col("_other"), 0).otherwise(1)
    return met.select("g", F.least("_number", "_other").alias("b1"), F.greatest("_number", "_other").alias("b2"), side.alias("side"), "c", "own", "label")


def similar_size(x: Column | str, y: Column | str) -> Column:
    return F.least(x, y) * DENOMINATOR >= F.greatest(x, y) * NUMERATOR


def near_hubs(held: DataFrame) -> DataFrame:
    """(``c``, ``hub``): the hub that a class shares most elements with, if it shares a quarter of its first prefix."""
    met = held.where("c <> hub").groupBy("c", "hub").agg(F.count(F.lit(1)).alias("_shared"), F.min("n").alias("n"))
    best = met.groupBy("c").agg(F.max_by("hub", "_shared").alias("hub"), F.max("_shared").alias("_shared"), F.min("n").alias("n"))
    first = F.col("n") - F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) + 1
    return materialise(best.where(F.col("_shared") * 4 >= first).select("c", "hub"), name="join-hubs")


def postings_across(held: DataFrame, info: DataFrame) -> DataFrame:
    """Postings (``token``, ``c``, ``m``, ``early``, ``n``, ``ell``, ``cluster``) of lists that hold several clusters; ``m`` is the length of what is left.

    A class that has fewer of them than it asks for, and than any class of a size
    that it may link with asks for, has no partner in other clusters and is left
    out. So texts that share one passage and little else do not meet in its lists.
    """
    known = held.select("token", "c", "early").join(info, "c")

    def spread(rows: DataFrame) -> DataFrame:
        lists = rows.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("cluster").alias("_lo"), F.max("cluster").alias("_hi"))
        return rows.join(lists.where("_lo <> _hi").select("token", "m"), "token")

    met = materialise(spread(known).drop("m"), name="join-met")
    # Sizes of a link differ by one step of this scale at most; two steps leave room for rounding.
    step = F.floor(F.log("n") / F.log(F.lit(DENOMINATOR / NUMERATOR)))
    asked = info.groupBy(step.alias("_size")).agg(F.min("ell").alias("ell"))
    asked = asked.select(F.explode(F.sequence(F.col("_size") - 2, F.col("_size") + 2)).alias("_size"), "ell").groupBy("_size").agg(F.min("ell").alias("_asked"))
    count = met.groupBy("c").agg(F.count(F.lit(1)).alias("_n"), F.min("ell").alias("ell"), F.min("n").alias("n"))
    able = count.withColumn("_size", step).join(asked, "_size").where(F.col("_n") >= F.least("ell", "_asked")).select("c")
    return materialise(spread(met.join(able, "c")), name="join-across")


def short_list_pairs(across: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) of classes across clusters that share enough prefix elements.

    What a pair shares is in short lists, which are counted, or in long ones: no
    more than either has there.
    """
    in_long = across.where(F.col("m") > SHORT_LIST).groupBy("c").agg(F.count(F.lit(1)).alias("_long"))
    short = across.where(F.col("m") <= SHORT_LIST)
    x, y = (short.select("token", *[F.col(k).alias(f"{k}_{s}") for k in ("c", "n", "ell", "cluster")]) for s in "ab")
    met = x.join(y, "token").where("c_a < c_b and cluster_a <> cluster_b").where(similar_size("n_a", "n_b"))
    counted = met.groupBy(F.col("c_a").alias("a"), F.col("c_b").alias("b")).agg(F.count(F.lit(1)).alias("_short"), F.least(F.min("ell_a"), F.min("ell_b")).alias("_least"))
    for s in "ab":
        counted = counted.join(in_long.select(F.col("c").alias(s), F.col("_long").alias(f"_long_{s}")), s, "left").na.fill(0, [f"_long_{s}"])
    return counted.where(F.col("_short") + F.least("_long_a", "_long_b") >= F.col("_least")).select("a", "b")


def jaccard_components(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``, the least id that links reach."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    seen = frequencies(texts)
    wide = fresh_path(spark, "join-rows")
    rows = materialise(described(texts, seen), path=wide)
    classes = rows.where("c is not null and id is not null").groupBy("c").agg(F.min("id").alias("rep"), *[F.first(k).alias(k) for k in ("n", "ell", "first", "prefix")])
    prefixes = fresh_path(spark, "join-classes")
    classes = materialise(classes, path=prefixes)
    rows = materialise(rows.select("id", "n", "c"), name="join-documents")
    drop_table(spark, wide)
    release_shuffles(spark)

    postings = classes.select("c", "n", "ell", "first", F.posexplode("prefix").alias("_at", "token"))
    postings = postings.select("token", "c", F.shiftleft("n", 1).bitwiseOR(F.when(F.col("_at") < F.col("first"), 1).otherwise(0)).alias("packed"), "ell").repartition("token")
    # All columns in the aggregate: so it reads the same shuffle as the join.
    lists = postings.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("hub"), F.min("packed").alias("_p"), F.min("ell").alias("_l")).where("m > 1")
    held = postings.join(lists.select("token", "m", "hub"), "token").select("token", "c", "m", "hub", (F.col("packed") % 2 == 1).alias("early"), F.shiftright("packed", 1).alias("n"), "ell")
    held = materialise(held, name="join-postings")
    classes = materialise(classes.select("c", "rep"), name="join-reps")
    drop_table(spark, prefixes)
    release_shuffles(spark)

    hubs = near_hubs(held)
    info = held.groupBy("c").agg(F.min("n").alias("n"), F.min("ell").alias("ell")).join(hubs, "c", "left").select("c", "n", "ell", F.coalesce("hub", "c").alias("cluster"))
    info = materialise(info, name="join-info")
    for _ in range(2):
        step = info.select(F.col("c").alias("cluster"), F.col("cluster").alias("_next"))
        info = materialise(info.join(step, "cluster").select("c", "n", "ell", F.col("_next").alias("cluster")), name="join-info")
    across = postings_across(held, info)
    edges = materialise(hubs.select(F.col("hub").alias("a"), F.col("c").alias("b")).union(short_list_pairs(across)), name="join-pairs")
    lists = materialise(across.where((F.col("m") > SHORT_LIST) & F.col("early")).select(F.col("token").alias("g"), "c", F.col("cluster").alias("own")), name="join-lists")

    wanted = edges.select(F.explode(F.array("a", "b")).alias("c")).union(lists.select("c")).distinct()
    sets = whole_sets(texts, materialise(wanted.join(classes, "c"), name="join-wanted"), seen)
    release_shuffles(spark)
    links = linked(star_members(edges), sets, "join-links")
    labels = components(links)
    known = info.join(labels.withColumnRenamed("a", "c"), "c", "left").select("c", "cluster", F.coalesce("label", "c").alias("label"))
    inner = known.join(hubs.select(F.explode(F.array("c", "hub")).alias("c")).distinct(), "c", "left_semi").select(F.col("cluster").alias("g"), "c", F.col("label").alias("own"), "label")
    more = linked(block_members(inner), sets, "join-inner").union(linked(block_members(lists.join(known.select("c", "label"), "c").select("g", "c", "own", "label")), sets, "join-long"))
    if not more.isEmpty():
        labels = components(links.union(more))

    grouped = labels.join(classes, labels.a == classes.c).select("c", "rep", "label")
    least = grouped.groupBy("label").agg(F.min("rep").alias("component_id"))
    found = classes.join(grouped.join(least, "label").select("c", "component_id"), "c", "left").select("c", F.coalesce("component_id", "rep").alias("component_id"))
    out = rows.join(found, "c", "left")
    component = F.when(F.col("id").isNull(), F.col("id")).otherwise(F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"))
