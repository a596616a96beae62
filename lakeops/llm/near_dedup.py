"""Near-duplicate classes of documents with fast similarity sketches.

1. A text is the set of hashes of its distinct 5-word shingles. Texts with one
   set are one class; all later steps see classes only, so exact copies cost a
   counted aggregate.
2. A sketch of T coordinates is filled in rounds: in round i each element picks
   a bin by hash and offers i plus a fraction; a bin keeps its least offer. After
   T random rounds, round T + b offers every element to bin b. So every
   coordinate fills, a large set after one round, and the share of equal
   coordinates concentrates around the Jaccard similarity.
3. Bands of R coordinates are bucket keys. In each bucket the class that shares
   most buckets with others is the hub, and every other class is paired with it:
   pairs grow with the bucket, not with its square. Pairs whose sketches agree
   too little are dropped; of the rest a class first tries its most alike hub.
4. Pairs are confirmed on full sets. Links give components; then only pairs of
   classes that share a bucket but not yet a component are left. They are
   compared in pairs of blocks of a bucket's members, by sketch and then on full
   sets, and only what joins two components comes out. No pair is written that
   does not link.

A link at similarity 0.75 is missed if no band agrees, (1 - 0.75**5)**48 or
about 2 in a million, and much less above.

Defined results
- words: lower-case A-Z, separated by ASCII white space. Fewer than 5 words are
  one shingle; null text and text without words have the empty set and link with
  nothing, not even each other.
- shingles and sets are equal if 64-bit hashes of them are.
- repeated ids are rows like others. A class takes part under its least id;
  rows with a null id stay alone, with a null component, and are kept.
- an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import fresh_path, materialise
from lakeops.llm.wanted import drop_table, likely_and_other_rows, release_shuffles, rows_of

WORDS = 5
COORDS, BAND_ROWS = 240, 5
BANDS = COORDS // BAND_ROWS
NUMERATOR, DENOMINATOR = 75, 100
#: The share of equal coordinates of a link lies 6 standard errors (0.028 at 0.75) above this.
LEAST_AGREEMENT = 0.58
BLOCK_MEMBERS = 256
CACHED_WORDS = 1 << 17

U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the output."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Hashes(dict):
    """Words to 64-bit hashes, kept for words already seen."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


def shingle_sets(texts: list[str | None], hashes: _Hashes) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        if not words:
            out.append(np.zeros(0, U))
            continue
        h = np.fromiter(map(hashes.__getitem__, words), U, len(words))
        k = min(WORDS, len(h))
        mix = np.zeros(len(h) - k + 1, U)
        for i in range(k):
            mix = mixed(mix * U(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
        out.append(np.unique(mixed(mix + U(k))))
    return out


def sketches(sets: list[np.ndarray], coords: int = COORDS) -> np.ndarray:
    """(sets, coords) coordinates by fast similarity sketching; empty sets get the largest value everywhere."""
    n, lens = len(sets), np.array([len(s) for s in sets], np.int64)
    full = np.iinfo(np.uint64).max
    table = np.full(n * coords, full, U)
    live = np.flatnonzero(lens)
    for i in range(2 * coords):
        if not len(live):
            break
        elements = np.concatenate([sets[k] for k in live])
        owner = np.repeat(live, lens[live])
        h = mixed(elements + U((i + 1) * 0x9E3779B97F4A7C15 % 2**64))
        bins = ((h >> U(32)) * U(coords) >> U(32)).astype(np.int64) if i < coords else np.full(len(h), i - coords)
        np.minimum.at(table, owner * coords + bins, (U(i) << U(48)) | (mixed(h) >> U(16)))
        live = live[(table.reshape(n, coords)[live] == full).any(axis=1)]
    return table.reshape(n, coords)


def band_keys(table: np.ndarray) -> np.ndarray:
    """(sets, bands) keys; the band is part of its key."""
    parts = table.reshape(len(table), -1, BAND_ROWS)
    key = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=U), parts.shape[:2]).copy()
    for i in range(BAND_ROWS):
        key = mixed(key * U(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def _class_of(elements: np.ndarray) -> int | None:
    """64 bits of a set; None for the empty one."""
    return int(np.array([xxhash.xxh3_64_intdigest(elements.tobytes())], U).view(np.int64)[0]) if len(elements) else None


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = _Hashes()
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.iloc[at : at + 500]
            sets = shingle_sets(part["text"].tolist(), hashes)
            table = sketches(sets)
            keys = band_keys(table)
            yield pd.DataFrame(
                {
                    "id": part["id"],
                    "t": part["t"],
                    "n": [len(s) for s in sets],
                    "c": pd.array([_class_of(s) for s in sets], "Int64"),
                    "bands": list(keys),
                    "sketch": [row.tobytes() for row in (mixed(table) >> U(56)).astype(np.uint8)],
                }
            )


def describe(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id``, ``t`` (hash of the text), ``n`` (set size), ``c`` (class, null if empty), band keys, and one byte of each coordinate."""
    rows = docs.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"), text_hash(text).alias("t"))
    return rows.mapInPandas(_describe, "id string, t long, n long, c long, bands array<long>, sketch binary").withColumn("id", F.col("id").cast("long"))


def text_hash(text: str) -> Column:
    """64 bits of a text; a null text is the empty one."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _agreeing(rows: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) with ``agree``, the share of equal coordinates, where sketches allow a link."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.frombuffer(b"".join(batch["sketch_a"]), np.uint8).reshape(-1, COORDS)
                y = np.frombuffer(b"".join(batch["sketch_b"]), np.uint8).reshape(-1, COORDS)
                agree = (x == y).mean(axis=1)
                yield batch[["a", "b"]].assign(agree=agree)[agree >= LEAST_AGREEMENT]

    return rows.select("a", "b", "sketch_a", "sketch_b").mapInPandas(compare, "a long, b long, agree double")


def _similar_size(x, y):
    """A link needs sizes that differ by the threshold at most."""
    return (F.least(x, y) * DENOMINATOR) >= (F.greatest(x, y) * NUMERATOR)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Elements that two sorted sets share."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _links(x: np.ndarray, y: np.ndarray) -> bool:
    common = _common(x, y)
    return DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common)


def full_sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, *, id: str, text: str) -> DataFrame:
    """(``c``, ``set``) of the wanted classes (``c``, distinct): their texts alone are read again."""

    def to_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for batch in batches:
            sets = shingle_sets(batch["text"].tolist(), hashes)
            yield pd.DataFrame({"c": [_class_of(s) for s in sets], "set": [s.tobytes() for s in sets]})

    reps = classes.join(wanted, "c", "left_semi").select(F.col("rep").alias(id)).distinct()
    texts = rows_of(docs.select(id, F.col(text).alias("text")), reps, id).where("text is not null")
    return materialise(texts.select("text").mapInPandas(to_sets, "c long, set binary").dropDuplicates(["c"]), name="dedup-sets")


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pairs (``a``, ``b``) of classes whose full sets link; each pair meets its two sets."""

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [_links(np.frombuffer(x, U), np.frombuffer(y, U)) for x, y in zip(batch["set_a"], batch["set_b"])]
            yield batch.loc[keep, ["a", "b"]]

    sets = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct(), classes, docs, id=id, text=text)
    met = pairs.select("a", "b").join(sets.withColumnsRenamed({"c": "a", "set": "set_a"}), "a").join(sets.withColumnsRenamed({"c": "b", "set": "set_b"}), "b")
    return materialise(met.select("a", "b", "set_a", "set_b").mapInPandas(linked, "a long, b long"), name="dedup-linked")


def _hub_pairs(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Each class with the hub of one of its buckets that is most alike."""
    degree = buckets.groupBy("c").agg(F.sum("size").alias("degree"))
    hubs = buckets.join(degree, "c").groupBy("key").agg(F.max(F.struct("degree", "c"))["c"].alias("hub"))
    pairs = buckets.join(hubs, "key").where("c <> hub").select(F.col("c").alias("a"), F.col("hub").alias("b")).distinct()
    sides = classes.select("c", "n", "sketch")
    met = pairs.join(sides.withColumnsRenamed({"c": "a", "n": "n_a", "sketch": "sketch_a"}), "a").join(sides.withColumnsRenamed({"c": "b", "n": "n_b", "sketch": "sketch_b"}), "b")
    best = _agreeing(met.where(_similar_size(F.col("n_a"), F.col("n_b")))).groupBy("a").agg(F.max(F.struct("agree", "b"))["b"].alias("b"))
    return materialise(best, name="dedup-hubs")


def _remaining_links(buckets: DataFrame, classes: DataFrame, labels: DataFrame, docs: DataFrame, *, id: str, text: str) -> DataFrame:
    """Links between classes that share a bucket but not yet a component.

    Members of a bucket fall into blocks by hash; each pair of blocks is one
    group of about twice ``BLOCK_MEMBERS`` rows that carry their full sets.
    There a pair from different components is compared by size, sketch and
    full set, in the first band that it shares only. A link joins its
    components at once, so a group gives fewer links than it has members. A
    bucket within one component is left out.
    """
    members = buckets.join(labels.withColumnRenamed("a", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
    still = members.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo <> hi").select("key", "m")
    members = materialise(members.drop("size").join(still, "key"), name="dedup-open")
    sets = full_sets(members.select("c").distinct(), classes, docs, id=id, text=text)
    carried = materialise(classes.select("c", "n", "sketch", "bands").join(sets, "c"), name="dedup-carried")
    members = members.withColumn("_blocks", F.ceil(F.col("m") / BLOCK_MEMBERS).cast("int")).withColumn("_block", F.pmod(F.xxhash64("c", "key"), F.col("_blocks")).cast("int"))
    members = members.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select("key", F.least("_block", "_other").alias("lo"), F.greatest("_block", "_other").alias("hi"), (F.col("_block") <= F.col("_other")).alias("first"), "c", "label")
    members = members.join(carried, "c")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if len(rows):
                group = np.stack([rows[k].to_numpy() for k in ("key", "lo", "hi")])
                starts = np.flatnonzero(np.concatenate([[True], (group[:, 1:] != group[:, :-1]).any(axis=0)]))
                yield links_of(rows.iloc[: starts[-1]], starts)
                rest = rows.iloc[starts[-1] :]
        if rest is not None:
            yield links_of(rest, np.array([0, len(rest)]))

    def links_of(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        """Links of whole groups, which begin at ``starts`` (the last entry is the end)."""
        if not len(rows):
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        key, same, c, label, n, first, sets = (rows[k].to_numpy() for k in ("key", "hi", "c", "label", "n", "first", "set"))
        same = same == rows["lo"].to_numpy()
        sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(-1, COORDS)
        bands = np.stack(rows["bands"].to_numpy())
        found: list[tuple[int, int]] = []
        for s, e in zip(starts[:-1], starts[1:]):
            if (label[s:e] == label[s]).all():
                continue
            members = np.arange(s, e)
            left, right = (members, members) if same[s] else (members[first[s:e]], members[~first[s:e]])
            parent, band = {x: x for x in label[s:e].tolist()}, int((bands[s] == key[s]).argmax())

            def top(x: int, parent: dict = parent) -> int:
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for i in left:
                j = right[right > i] if same[s] else right
                j = j[(label[j] != label[i]) & (DENOMINATOR * np.minimum(n[j], n[i]) >= NUMERATOR * np.maximum(n[j], n[i]))]
                if len(j):
                    agree = (sketch[j] == sketch[i]).mean(axis=1)
                    here = (agree >= LEAST_AGREEMENT) & ((bands[j] == bands[i]).argmax(axis=1) == band)
                    for k in j[here][np.argsort(-agree[here], kind="stable")]:
                        if top(label[i]) != top(label[k]) and _links(np.frombuffer(sets[i], U), np.frombuffer(sets[k], U)):
                            found.append((c[i], c[k]))
                            parent[top(label[i])] = top(label[k])
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    grouped = members.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return materialise(grouped.mapInPandas(compare, "a long, b long"), name="dedup-more")


def components(links: DataFrame, name: str = "dedup-labels") -> DataFrame:
    """(``a``, ``label``): the least id that links reach, for every id of a link.

    Every id takes the least label among itself and its neighbours, then the
    label of its label, until no label changes. Each round is written.
    """
    both = materialise(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), name=f"{name}-links")
    labels = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")), name=name)
    while True:
        near = both.join(labels.withColumnsRenamed({"a": "b", "label": "other"}), "b").groupBy("a").agg(F.min("other").alias("other"))
        step = labels.join(near, "a").select("a", F.least("label", "other").alias("near"), F.col("label").alias("was"))
        jump = step.select(F.col("a").alias("_to"), F.col("near").alias("_far"))
        after = step.join(jump, step.near == jump._to, "left").select("a", F.least("near", F.coalesce("_far", "near")).alias("label"), "was")
        after = materialise(after, name=name)
        labels = after.select("a", "label")
        if after.where("label <> was").isEmpty():
            return labels


def _grouped(docs: DataFrame, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (``id``, ``t``, ``n``, ``c``) of all documents, and the ``label`` and ``component_id`` of each class ``c``."""
    spark = docs.sparkSession
    wide = fresh_path(spark, "dedup-sketches")
    rows = materialise(describe(docs, id=id, text=text), path=wide)
    named = rows.where("c is not null and id is not null")
    classes = named.groupBy("c").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = materialise(classes, name="dedup-classes")
    rows = materialise(rows.select("id", "t", "n", "c"), name="dedup-rows")
    drop_table(spark, wide)
    release_shuffles(spark)
    postings = classes.select(F.explode("bands").alias("key"), "c")
    shared = materialise(postings.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), name="dedup-shared")
    buckets = materialise(postings.join(shared, "key"), name="dedup-buckets")
    release_shuffles(spark)
    links = confirmed(_hub_pairs(buckets, classes), docs, classes, id=id, text=text)
    labels = components(links)
    release_shuffles(spark)
    more = _remaining_links(buckets, classes, labels, docs, id=id, text=text)
    if not more.isEmpty():
        labels = components(links.union(more))
    release_shuffles(spark)
    # The least id of a label comes from its classes; rows are met once, by class.
    held = labels.withColumnRenamed("a", "c").join(classes.select("c", "rep"), "c")
    least = held.groupBy("label").agg(F.min("rep").alias("component_id"))
    linked = held.join(least, "label").select("c", "label", "component_id")
    found = classes.select("c", "rep").join(linked, "c", "left").select("c", F.coalesce("label", "c").alias("label"), F.coalesce("component_id", "rep").alias("component_id"))
    return rows, materialise(found, name="dedup-components")


def near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (least id reachable) and ``kept`` (it is its own component id)."""
    rows, found = _grouped(docs, id, text)
    out = rows.join(found, "c", "left").withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")))
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns: one document of each component.

    A document is an id and a text: of a component the least id stays, and of
    its texts one. Rows that repeat both are one document, so one of them stays.
    Texts without words link with nothing and stay, and so do rows with a null id.
    Rows whose id loses no document are passed on without a shuffle.
    """
    rows, found = _grouped(docs, id, text)
    known = rows.where("id is not null").join(found.select("c", "label"), "c", "left")
    best = known.where("label is not null").groupBy("label").agg(F.min(F.struct("id", "t")).alias("_best")).select("_best.*")
    kept = materialise(best.union(known.where("label is null").select("id", "t")).distinct(), name="dedup-kept")
    per_row = rows.where("id is not null").groupBy("id", "t").agg(F.count(F.lit(1)).alias("_rows"))
    lost = per_row.join(kept, ["id", "t"], "left_anti").select("id", "t", F.lit(0).alias("_keep"))
    again = per_row.where("_rows > 1").join(kept, ["id", "t"], "left_semi").select("id", "t", F.lit(1).alias("_keep"))
    cases = materialise(lost.union(again), name="dedup-cases")
    release_shuffles(docs.sparkSession)
    # Only ids with a lost or a repeated document are looked up.
    some, others = likely_and_other_rows(docs.where(F.col(id).isNotNull()), cases.select(F.col("id").alias(id)).distinct(), id)
    case = cases.select(F.col("id").alias("_id"), F.col("t").alias("_t"), "_keep")
    met = some.join(case, (F.col(id) == F.col("_id")) & (text_hash(text) == F.col("_t")), "left")
    single = met.where("_keep is null").select(*docs.columns)
    repeated = met.where("_keep = 1").select(*docs.columns).dropDuplicates([id, text])
    return others.unionByName(single).unionByName(repeated).unionByName(docs.where(F.col(id).isNull()))
