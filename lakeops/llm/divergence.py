"""How the sources of each language differ in their terms, counted by chunk factorization.

1. Documents are read in blocks of a few million words. A block counts the chunks
   between white space of each of its documents, and writes one row per language
   and chunk: the documents that hold it (numbers within the block) and how often
   each (language, source) group does. No text leaves the block.
2. Every distinct chunk is tokenized once, and its terms are joined back to the
   rows of the chunk. As a term never crosses white space, a text's terms are
   those of its chunks.
3. Rows of one term and block are merged, in order of term and block: the union
   of their document numbers gives distinct documents, the sums give occurrences.
   A term whose chunks together do not reach enough documents is left out before
   that, and a bitmap of fixed size keeps the rows of its chunks from the shuffle.
4. Shares p and their differences are integers. The pairs of a language's sources
   are added up term bucket by term bucket, as a matrix over its sources.

Defined results
- null text, lang and source are empty texts; repeated ids are documents like others.
- a group without kept terms still gets its pairs; a language without kept terms has pairs of value 0.
- ties in value are ordered by the item's UTF-8 bytes.
- an empty table gives an empty result; other columns are not carried.
- groups are numbered by one window over the distinct groups, and every ordered pair of a language's
  sources is a row of the result, so groups are meant to be thousands, not millions.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import fresh_path, materialise
from lakeops.llm.wanted import drop_table, likely_rows, release_shuffles

#: Fixed value: what a term is made of.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 30
ONE = 1_000_000_000
PRIOR = 5
TOP = 50
BLOCK_WORDS, BLOCK_DOCS = 3_000_000, 65_536
BUCKET_TERMS = 1000
#: So many input partitions (a power of two) share the rows of a term in one task; a very frequent term is in several.
PARTITION_BITS = 6
#: A place is a language, an input partition and a block in it, in one number.
BLOCK_BITS, LANG_SHIFT = 20, 44

#: Distinct chunks whose rows are made at once.
CHUNKS_AT_ONCE = 40_000

BLOCK_SCHEMA = "place long, chunk string, n_docs int, held binary"


class _Places(dict):
    """Chunks to their number; a new one gets the next."""

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = place = len(self)
        return place


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of ranges that begin at ``starts``, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def _gaps(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Differences inside each row of increasing values; the first one of a row stays."""
    out = np.diff(values, prepend=0)
    first = np.cumsum(lengths) - lengths
    out[first] = values[first]
    return out


def _sums(gaps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The values again."""
    total = np.cumsum(gaps)
    first = np.cumsum(lengths) - lengths
    return total - np.repeat(total[first] - gaps[first], lengths)


def packed(docs: np.ndarray, n_docs: np.ndarray, groups: np.ndarray, counts: np.ndarray, n_groups: np.ndarray) -> pa.Array:
    """One value a row, seven bits a byte: how many documents and groups, the documents, the groups, their counts."""
    lengths = 2 + n_docs + 2 * n_groups
    starts = np.cumsum(lengths) - lengths
    numbers = np.empty(int(lengths.sum()), np.int64)
    numbers[starts], numbers[starts + 1] = n_docs, n_groups
    numbers[_ranges(starts + 2, n_docs)] = _gaps(docs, n_docs)
    numbers[_ranges(starts + 2 + n_docs, n_groups)] = _gaps(groups, n_groups)
    numbers[_ranges(starts + 2 + n_docs + n_groups, n_groups)] = counts
    size = np.ones(len(numbers), np.int64)
    while (more := numbers >> (7 * size) > 0).any():
        size += more
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        here = size > k
        out[at[here] + k] = (numbers[here] >> (7 * k)) & 127 | np.where(size[here] > k + 1, 128, 0)
    offsets = np.append(at[starts], len(out)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def unpacked(held: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents, groups and counts of all rows, and the number of documents and of groups of each row."""
    ends = np.frombuffer(held.buffers()[1], np.int32)[held.offset : held.offset + len(held) + 1].astype(np.int64)
    data = np.frombuffer(held.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    shift = 7 * (np.arange(len(data)) - np.repeat(first, last - first + 1))
    numbers = np.add.reduceat((data & 127).astype(np.int64) << shift, first) if len(first) else np.zeros(0, np.int64)
    starts = np.searchsorted(first, ends[:-1] - ends[0])
    n_docs, n_groups = numbers[starts], numbers[starts + 1]
    docs = _sums(numbers[_ranges(starts + 2, n_docs)], n_docs)
    groups = _sums(numbers[_ranges(starts + 2 + n_docs, n_groups)], n_groups)
    return docs, groups, numbers[_ranges(starts + 2 + n_docs + n_groups, n_groups)], n_docs, n_groups


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a sorted sequence changes in any key."""
    changed = np.ones(len(keys[0]), bool)
    if len(changed):
        changed[1:] = False
        for k in keys:
            changed[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(changed)


def block_rows(number: int, langs: np.ndarray, groups: np.ndarray, chunks: list[bytes], words: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The rows of one block, some chunks at a time: documents are numbered by group, so each row's documents and groups are sorted."""
    order = np.lexsort((np.arange(len(groups)), groups, langs))
    langs, groups = langs[order], groups[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    key = np.concatenate(words).astype(np.int64)
    key *= BLOCK_DOCS
    key += np.repeat(rank, [len(w) for w in words])
    words.clear()
    key.sort()
    for first in range(0, len(chunks), CHUNKS_AT_ONCE):
        some = chunks[first : first + CHUNKS_AT_ONCE]
        lo, hi = np.searchsorted(key, (first * BLOCK_DOCS, (first + len(some)) * BLOCK_DOCS))
        yield _chunk_rows(number, langs, groups, some, key[lo:hi] - first * BLOCK_DOCS)


def _chunk_rows(number: int, langs: np.ndarray, groups: np.ndarray, chunks: list[bytes], key: np.ndarray) -> pa.RecordBatch:
    """Rows of some chunks from sorted occurrences (chunk and document in one number)."""
    at = _runs(key)  # one document of one chunk
    occurrences = np.diff(np.append(at, len(key)))
    chunk, doc = np.divmod(key[at], BLOCK_DOCS)
    lang, group = langs[doc], groups[doc]
    by_group, by_row = _runs(chunk, lang, group), _runs(chunk, lang)
    counts = np.add.reduceat(occurrences, by_group) if len(by_group) else np.zeros(0, np.int64)
    names = pa.array(chunks, pa.binary()).take(pa.array(chunk[by_row])).cast(pa.string())
    n_docs, n_groups = np.diff(np.append(by_row, len(chunk))), np.diff(np.append(np.searchsorted(by_group, by_row), len(by_group)))
    held = packed(doc, n_docs, group[by_group], counts, n_groups)
    place = (lang[by_row].astype(np.int64) << LANG_SHIFT) + number
    return pa.RecordBatch.from_arrays([pa.array(place), names, pa.array(n_docs.astype(np.int32)), held], ["place", "chunk", "n_docs", "held"])


def _factorized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << BLOCK_BITS
    places, words, langs, groups, held = _Places(), [], [], [], 0

    def block() -> Iterator[pa.RecordBatch]:
        if held:
            yield from block_rows(number, np.array(langs), np.array(groups), list(places), words)

    for batch in batches:
        for text, lang, group in zip(batch.column("text").cast(pa.binary()), batch.column("lang_id").to_pylist(), batch.column("group_id").to_pylist()):
            chunks = text.as_py().split()
            words.append(np.fromiter(map(places.__getitem__, chunks), np.int32, len(chunks)))
            langs.append(lang)
            groups.append(group)
            held += len(chunks)
            if held >= BLOCK_WORDS or len(words) == BLOCK_DOCS:
                yield from block()
                number += 1
                places, words, langs, groups, held = _Places(), [], [], [], 0
    yield from block()


def chunk_rows(docs: DataFrame) -> DataFrame:
    """One row per block, language and chunk, from rows of ``lang_id``, ``group_id`` and ``text``."""
    path = fresh_path(docs.sparkSession, "term-chunks")
    docs.select("lang_id", "group_id", "text").mapInArrow(_factorized, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(BLOCK_SCHEMA).parquet(path)


def terms_of(chunk) -> F.Column:
    """All terms of a text, in order, as an array."""
    return F.regexp_extract_all(F.translate(chunk, string.ascii_uppercase, string.ascii_lowercase), F.lit(TERM), F.lit(0))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by term and place: ``n`` by language and group, and distinct documents as group -1. A place's rows of a term may span batches."""

    def merge(rows: pa.Table) -> pa.RecordBatch:
        batch = rows.combine_chunks().to_batches()[0]
        place = batch.column("place").to_numpy()
        lang, code = place >> LANG_SHIFT, batch.column("term").dictionary_encode().indices.to_numpy()
        docs, groups, counts, n_docs, n_groups = unpacked(batch.column("held"))
        by_term = _runs(code, lang)
        term_of = np.repeat(np.arange(len(by_term)), np.diff(np.append(by_term, len(batch))))
        merged = _runs(code, place)
        unit_of = np.repeat(np.arange(len(merged)), np.diff(np.append(merged, len(batch))))
        key = np.repeat(unit_of, n_docs) * BLOCK_DOCS + docs
        key.sort()
        distinct = np.bincount(term_of[merged][key[_runs(key)] // BLOCK_DOCS], minlength=len(by_term))
        row = np.repeat(term_of, n_groups)
        order = np.lexsort((groups, row))
        row, groups, counts = row[order], groups[order], counts[order]
        at = _runs(row, groups)
        row = np.concatenate([row[at], np.arange(len(by_term))])
        group_id = np.concatenate([groups[at], np.full(len(by_term), -1)]).astype(np.int32)
        n = np.concatenate([np.add.reduceat(counts, at) if len(at) else counts, distinct])
        return pa.RecordBatch.from_arrays([pa.array(lang[by_term[row]].astype(np.int32)), batch.column("term").take(pa.array(by_term[row])), pa.array(group_id), pa.array(n)], ["lang_id", "term", "group_id", "n"])

    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if not len(rows):
            continue
        same = pc.and_(pc.equal(rows.column("place"), rows.column("place")[-1]), pc.equal(rows.column("term"), rows.column("term")[-1]))
        cut = len(rows) - pc.sum(same).as_py()
        if cut:
            yield merge(rows.slice(0, cut))
        rest = rows.slice(cut)
    if rest is not None:
        yield merge(rest)


def kept_counts(rows: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """The kept terms (``lang_id``, ``term``), and the occurrences ``n`` of each in each group that has it."""
    chunks = rows.groupBy("chunk").agg(F.sum("n_docs").alias("n_docs"))
    path = fresh_path(rows.sparkSession, "term-tokens")
    tokens = materialise(chunks.select("chunk", "n_docs", F.explode(terms_of("chunk")).alias("term")), path=path)
    # A term has no more documents than its chunks together.
    enough = tokens.groupBy("term").agg(F.sum("n_docs").alias("_most")).where(F.col("_most") >= least_docs).select("term")
    wanted = materialise(tokens.select("chunk", "term").join(enough, "term", "left_semi"), name="term-wanted")
    drop_table(rows.sparkSession, path)
    release_shuffles(rows.sparkSession)
    joined = likely_rows(rows.drop("n_docs"), wanted.select("chunk").distinct(), "chunk").join(wanted, "chunk").select("place", "term", "held")
    salt = F.shiftright("place", BLOCK_BITS + PARTITION_BITS)
    placed = joined.repartition("term", salt).sortWithinPartitions("term", "place")
    merged = placed.mapInArrow(_merged, "lang_id int, term string, group_id int, n long")
    counts = materialise(merged.groupBy("lang_id", "term", "group_id").agg(F.sum("n").alias("n")), name="term-counts")
    kept = materialise(counts.where((F.col("group_id") == -1) & (F.col("n") >= least_docs)).select("lang_id", "term"), name="term-kept")
    return kept, materialise(counts.where("group_id >= 0").join(kept, ["lang_id", "term"], "left_semi"), name="term-kept-counts")


def share(n: str, total: str, terms: str) -> F.Column:
    """1 + floor(ONE * (n + PRIOR) / (total + PRIOR * terms)), exactly."""
    return F.expr(f"1 + (cast({ONE} as decimal(12, 0)) * cast({n} + {PRIOR} as decimal(20, 0))) div cast({total} + {PRIOR} * {terms} as decimal(20, 0))")


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of |p - q| over the terms of each bucket, for every ordered pair of a language's groups."""
    for batch in batches:
        for k in range(len(batch)):
            groups, rest, found = (batch.column(c)[k].values for c in ("groups", "rests", "found"))
            groups, rest = groups.to_numpy(), rest.to_numpy()
            order = np.argsort(groups)
            groups, rest = groups[order], rest[order]
            names = found.field("term").dictionary_encode()
            p = np.tile(rest, (len(names.dictionary), 1))
            p[names.indices.to_numpy(), np.searchsorted(groups, found.field("group_id").to_numpy())] = found.field("p").to_numpy()
            sums = np.stack([np.abs(p - p[:, g : g + 1]).sum(axis=0) for g in range(len(groups))])
            a, b = np.divmod(np.arange(sums.size), len(groups))
            yield pa.RecordBatch.from_arrays([pa.array(groups[a].astype(np.int32)), pa.array(groups[b].astype(np.int32)), pa.array(sums.reshape(-1))], ["group_id", "other_id", "value"])


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` of pairs of sources and of the terms that mark a source."""
    named = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    distinct = named.select("lang", "source").distinct()
    ranks = [F.row_number().over(Window.orderBy("lang", "source")).alias("group_id"), F.dense_rank().over(Window.orderBy("lang")).alias("lang_id")]
    groups = materialise(distinct.select("lang", "source", *ranks), name="term-groups")
    kept, counts = kept_counts(chunk_rows(named.join(groups, ["lang", "source"])), least_docs)

    terms = kept.groupBy("lang_id").agg(F.count(F.lit(1)).alias("terms"))
    sizes = counts.groupBy("group_id").agg(F.sum("n").alias("total"))
    sized = groups.join(terms, "lang_id", "left").join(sizes, "group_id", "left").na.fill(0, ["terms", "total"])
    sized = materialise(sized, name="term-sizes")
    of_lang = sized.groupBy("lang_id").agg(F.sum("total").alias("lang_total"))
    placed = materialise(counts.join(sized.select("group_id", "total", "terms"), "group_id").withColumn("p", share("n", "total", "terms")), name="term-shares")

    rests = sized.where("terms > 0").groupBy("lang_id").agg(F.collect_list(F.struct("group_id", share("0", "total", "terms").alias("rest"))).alias("all"))
    bucket = F.pmod(F.xxhash64("term"), F.ceil(F.col("terms") / BUCKET_TERMS)).alias("bucket")
    buckets = placed.groupBy("lang_id", bucket).agg(F.collect_list(F.struct("term", "group_id", "p")).alias("found"))
    buckets = buckets.join(rests, "lang_id").select("found", F.col("all.group_id").alias("groups"), F.col("all.rest").alias("rests"))
    sums = buckets.mapInArrow(_differences, "group_id int, other_id int, value long").groupBy("group_id", "other_id").agg(F.sum("value").alias("value"))
    others = groups.select("lang_id", F.col("source").alias("item"), F.col("group_id").alias("other_id"))
    pairs = groups.join(others, "lang_id").where("group_id <> other_id").join(sums, ["group_id", "other_id"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    in_lang = placed.groupBy("lang_id", "term").agg(F.sum("n").alias("lang_n")).join(of_lang, "lang_id")
    marked = placed.join(in_lang, ["lang_id", "term"]).withColumn("value", F.col("p") - share("lang_n", "lang_total", "terms")).where("value > 0")
    marked = marked.select("group_id", F.col("term").alias("item"), "value").join(groups, "group_id").select("lang", "source", F.lit("term").alias("part"), "item", "value")

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(marked.withColumn("rank", rank).where(F.col("rank") <= top))
