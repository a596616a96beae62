"""Token ids of documents in patched frame-of-reference files.

Rows are range-partitioned and sorted by id. Each task encodes its texts and
writes files of bounded size; a file holds the ids of whole documents as blocks
of 128 values. A block stores its minimum, a bit width that fits 90 of 100 of
its values, the packed low bits of all, and a list of the values that need more
bits. An index of block starts gives access to any range of ids without reading
the rest. The manifest, a table with one row per file, is the commit: files
that a lost task left are not in it and are never read.

Defined results
- null text is empty; every document gets the end id, so empty texts have one.
- rows with one id are ordered by a hash of their text; a null id comes first.
- a document longer than a file's bound gets a file of its own.
- other columns are not carried; an empty table gives no file and no row.
"""

from __future__ import annotations

import functools
import itertools
import os
import string
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import fresh_path, materialise

MAGIC = b"PFR1"
HEADER = struct.Struct("<4sIQQ")  # magic, ids in a block, ids, documents
BLOCK = 128
PERCENTILE = 90
#: Blocks that are packed or unpacked at once.
SLICE = 2048
FILE_IDS = 4_000_000
#: Parts that a worker process keeps, about 150 bytes each.
CACHED_WORDS = 1 << 19
#: Chunks whose ids are put in place at once.
CHUNKS_AT_ONCE = 1 << 16


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of ids as bytes, and where each block starts (one more entry for the end)."""
    bodies, sizes = [np.zeros(0, np.uint8)], [np.zeros(1, np.int64)]
    for k in range(0, len(ids), SLICE * BLOCK):
        body, size = _pack_slice(ids[k : k + SLICE * BLOCK])
        bodies.append(body)
        sizes.append(size)
    return np.concatenate(bodies), np.cumsum(np.concatenate(sizes)).astype(np.uint64)


def _pack_slice(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some blocks as bytes, and the size of each."""
    count = -(-len(ids) // BLOCK)
    padded = np.concatenate([ids, np.repeat(ids[-1:], count * BLOCK - len(ids))]).astype(np.uint32).reshape(count, BLOCK)
    least = padded.min(axis=1)
    delta = padded - least[:, None]
    rank = -(-BLOCK * PERCENTILE // 100) - 1
    width = np.frexp(np.partition(delta, rank, axis=1)[:, rank].astype(np.float64))[1].astype(np.int64)
    outlier = delta >> np.minimum(width, 31).astype(np.uint32)[:, None] > 0
    outlier &= (width < 32)[:, None]
    patches = outlier.sum(axis=1)
    sizes = 6 + width * (BLOCK // 8) + 5 * patches
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(4)] = least.astype("<u4").view(np.uint8).reshape(count, 4)
    out[starts + 4], out[starts + 5] = width, patches
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        low = delta[at].T.astype(np.uint64) & np.uint64((1 << w) - 1)
        words = np.zeros((2 * w, len(at)), np.uint64)
        for i in range(BLOCK):
            word, shift = divmod(i * w, 64)
            words[word] |= low[i] << np.uint64(shift)
            if shift + w > 64:
                words[word + 1] |= low[i] >> np.uint64(64 - shift)
        out[starts[at, None] + 6 + np.arange(16 * w)] = np.ascontiguousarray(words.T, "<u8").view(np.uint8)
    block, place = np.nonzero(outlier)
    nth = np.arange(len(block)) - (np.cumsum(patches) - patches)[block]
    tail = starts[block] + 6 + width[block] * (BLOCK // 8)
    out[tail + nth] = place
    out[(tail + patches[block] + 4 * nth)[:, None] + np.arange(4)] = delta[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out, sizes


def unpack(body: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The values of the blocks that start at ``starts`` (the last entry is the end) in ``body``."""
    at = starts[:-1].astype(np.int64)
    out = np.zeros((len(at), BLOCK), np.uint32)
    for k in range(0, len(at), SLICE):
        _unpack_slice(body, at[k : k + SLICE], out[k : k + SLICE])
    return out.reshape(-1)


def _unpack_slice(body: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
    """Fill ``out`` with the values of the blocks ``at``."""
    least = body[at[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    width, patches = body[at + 4].astype(np.int64), body[at + 5].astype(np.int64)
    for w in np.unique(width[width > 0]).tolist():
        k = np.flatnonzero(width == w)
        words = np.ascontiguousarray(body[at[k, None] + 6 + np.arange(16 * w)]).view("<u8").T.copy()
        values = np.empty((BLOCK, len(k)), np.uint32)
        mask = np.uint64((1 << w) - 1)
        for i in range(BLOCK):
            word, shift = divmod(i * w, 64)
            value = words[word] >> np.uint64(shift)
            if shift + w > 64:
                value |= words[word + 1] << np.uint64(64 - shift)
            values[i] = value & mask
        out[k] = values.T
    block = np.repeat(np.arange(len(at)), patches)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(patches) - patches, patches)
    tail = at[block] + 6 + width[block] * (BLOCK // 8)
    out[block, body[tail + nth]] = body[(tail + patches[block] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    out += least[:, None]


def file_bytes(doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A whole file."""
    return b"".join(file_parts(doc_ids, counts, ids))


def file_parts(doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> list:
    """A file in parts: header, documents (has an id, id, number of ids), block starts, blocks."""
    body, starts = pack(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    names = np.array([0 if d is None else d for d in doc_ids], "<i8")
    return [HEADER.pack(MAGIC, BLOCK, len(ids), len(doc_ids)), known, names, counts.astype("<u8"), starts.astype("<u8"), body]


class TokenFile:
    """A file opened for reading; ids are read by range, through the index."""

    def __init__(self, source):
        self.source = source
        magic, block, self.n_ids, self.n_docs = HEADER.unpack(source.read(HEADER.size))
        if magic != MAGIC or block != BLOCK:
            raise ValueError("not a token file")
        known = np.frombuffer(source.read(self.n_docs), np.uint8)
        names = np.frombuffer(source.read(8 * self.n_docs), "<i8")
        self.doc_ids = [int(n) if k else None for k, n in zip(known, names)]
        self.counts = np.frombuffer(source.read(8 * self.n_docs), "<u8").astype(np.int64)
        self.starts = np.frombuffer(source.read(8 * (-(-self.n_ids // BLOCK) + 1)), "<u8").astype(np.int64)
        self.body_at = HEADER.size + 17 * self.n_docs + 8 * len(self.starts)

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids ``first`` to ``last``, the end excluded; only their blocks are read."""
        last = self.n_ids if last is None else min(last, self.n_ids)
        if first >= last:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, -(-last // BLOCK)
        self.source.seek(self.body_at + int(self.starts[a]))
        body = np.frombuffer(self.source.read(int(self.starts[b] - self.starts[a])), np.uint8)
        return unpack(body, self.starts[a : b + 1] - self.starts[a])[first - a * BLOCK : last - a * BLOCK]


class _Places(dict):
    """Parts to their number; a new part gets the next one."""

    def __missing__(self, part: str) -> int:
        self[part] = place = len(self)
        return place


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of ranges that begin at ``starts``, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def _bounds(lengths: np.ndarray) -> np.ndarray:
    """Where each of consecutive ranges starts, and the end of the last."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)])


class Encoder:
    """Texts to ids.

    A tokenizer is asked to prove that it treats the chunks between ASCII white space
    alone, in them a letter and the ASCII marks that end the chunk, and capitals like
    small letters. Then each distinct chunk of a batch is looked up once; its parts
    are encoded once and kept, up to ``CACHED_WORDS`` parts.
    """

    PROBES = ("a b", "Word\tword, two", "it's\n<x> 12", " lead and  gap ", "é ſ́ ñ\r\nz", "One, two. Three. a., b.c d,", "x.\ny, z.", "É! ñ### x?) (y); z,*** it's. 'tis!", string.ascii_uppercase, f"ab{string.punctuation.replace(chr(39), '')} Ü{string.punctuation}")
    #: Letters in all versions of Unicode whose small forms are letters too; that of U+0130 ends with a mark.
    LETTER = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}\x{400}-\x{481}]"
    #: Marks that may stand between parts, so that one id tells the parts of a long text apart.
    DIVIDERS = "|~^`"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()
        # What a token added to the vocabulary may hold is left together.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        marks = "".join(f"\\x{ord(c):02x}" for c in string.punctuation if c != "'" and not any(c in t for t in added))
        self.marked = f"({self.LETTER})([{marks}]+)$"
        self.by_part = any(self._proven(lower and not any(map(str.isalpha, added))) for lower in (True, False))
        self.dividers = {d: ids[0] for d in self.DIVIDERS if len(ids := self.whole([d])[0]) == 1}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def _proven(self, lower: bool) -> bool:
        self.lower = lower
        return all(self.whole([p])[0] == list(itertools.chain(*self.whole(self._parts(pa.array(p.split()))[0].to_pylist()))) for p in self.PROBES)

    def _forget(self) -> None:
        self.place = _Places({"": 0})
        self.flat, self.bounds = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _parts(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The parts of all chunks, and how many each has."""
        parts = pc.split_pattern(pc.replace_substring_regex(chunks, self.marked, r"\1 \2"), " ")
        n, parts = pc.list_value_length(parts).to_numpy(), parts.flatten()
        return (pc.if_else(self._worded(parts), pc.ascii_lower(parts), parts) if self.lower else parts), n

    def _worded(self, parts: pa.Array) -> pa.Array:
        """Which parts are of letters alone."""
        return pc.match_substring_regex(parts, f"^{self.LETTER}+$")

    def _words(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Number of ids of each part, and all ids, by the ids that end a word; None if the parts are not of one word each."""
        [found] = self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        # No part is without a word, so as many words as parts are one in each.
        at = np.flatnonzero(self.is_end[ids])
        if len(at) != len(parts) or at[-1] != len(ids) - 1:
            return None
        return np.diff(at, prepend=-1), ids

    def _divided(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same by dividers between the parts; None if the parts have all dividers of their own."""
        own = set("".join(parts))
        mark = next((d for d in self.dividers if d not in own), None)
        if mark is None:
            return None
        [found] = self.tokenizer.encode_batch_fast([f" {mark} ".join(parts)], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        at = np.flatnonzero(ids == self.dividers[mark])
        if len(at) != len(parts) - 1:
            return None
        return np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1, np.delete(ids, at)

    def _offset(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same by where each id's characters start."""
        found = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        ends = np.cumsum([len(p) + 1 for p in parts])
        owner = np.searchsorted(ends, np.array([s for s, _ in found.offsets], np.int64), side="right")
        return np.bincount(owner, minlength=len(parts)), np.array(found.ids, np.uint32)

    def _encoded(self, parts: list[str], at_once: int = 2000) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each part, and all ids: many parts are encoded as one text."""
        worded = self._worded(pa.array(parts, pa.string())).to_numpy(zero_copy_only=False)
        lengths, found = np.empty(len(parts), np.int64), []
        for which, way in ((worded, self._words), (~worded, self._divided)):
            some = list(itertools.compress(parts, which))
            got = [way(x) or self._offset(x) for k in range(0, len(some), at_once) if (x := some[k : k + at_once])]
            lengths[which] = np.concatenate([np.zeros(0, np.int64), *(n for n, _ in got)])
            found.append((which, np.concatenate([np.zeros(0, np.uint32), *(ids for _, ids in got)])))
        bounds = _bounds(lengths)
        out = np.empty(bounds[-1], np.uint32)
        for which, ids in found:
            out[_ranges(bounds[:-1][which], lengths[which])] = ids
        return lengths, out

    def _places(self, parts: list[str]) -> np.ndarray:
        """Where the parts are kept; those not seen before are encoded."""
        if len(self.place) > CACHED_WORDS:
            self._forget()
        known = len(self.place)
        at = np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))
        if len(self.place) > known:
            more, ids = self._encoded(list(itertools.islice(reversed(self.place), len(self.place) - known))[::-1])
            self.flat = np.concatenate([self.flat, ids])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(more)])
        return at

    def __call__(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        if not self.by_part:
            return [np.array(x, np.uint32) for x in self.whole(pa.array(texts, pa.string()).to_pylist())]
        chunks = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        sizes, chunks = pc.list_value_length(chunks).to_numpy(), chunks.flatten().dictionary_encode()
        parts, n_parts = self._parts(chunks.dictionary)
        parts = parts.dictionary_encode()
        at = self._places(parts.dictionary.to_pylist())[parts.indices.to_numpy()]
        # From here on only the ids of this batch's distinct chunks are read.
        lengths = np.diff(self.bounds)[at]
        flat, first = self.flat[_ranges(self.bounds[at], lengths)], _bounds(lengths)[_bounds(n_parts)]
        starts, lengths = first[:-1], np.diff(first)
        place = chunks.indices.to_numpy()
        ends = _bounds(lengths[place])
        ids = np.empty(ends[-1], np.uint32)
        for k in range(0, len(place), CHUNKS_AT_ONCE):
            some = place[k : k + CHUNKS_AT_ONCE]
            ids[ends[k] : ends[k + len(some)]] = flat[_ranges(starts[some], lengths[some])]
        return np.split(ids, ends[_bounds(sizes)[1:-1]])


@functools.cache
def _encoder(path: str) -> Encoder:
    """One encoder for all tasks that a worker process runs."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def _file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, tokenizer: str, *, folder: str | None = None, id: str = "doc_id", text: str = "text", end_id: int = 1, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the files and return the manifest: ``path``, ``n_docs``, ``n_ids`` and ``first_id`` (ids in all files before)."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, (fs, root) = _encoder(tokenizer), _file_system(folder)
        end = np.array([end_id], np.uint32)
        rows: list[dict] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            path = f"{root}/{uuid.uuid4().hex}.pfor"
            counts = np.array([len(ids) + 1 for ids in held])
            ids = np.concatenate([x for ids in held for x in (ids, end)])
            held.clear()
            parts = file_parts([r["id"] for r in rows], counts, ids)
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(path) as out:
                for part in parts:
                    out.write(part)
            return pa.RecordBatch.from_pylist([{"path": path, "n_docs": len(rows), "n_ids": size} | rows[0]], manifest_schema)

        manifest_schema = pa.schema([("path", pa.string()), *((k, pa.int64()) for k in ("n_docs", "n_ids", "id", "tie", "row"))])
        for batch in batches:
            for row, ids in zip(batch.select(["id", "tie", "row"]).to_pylist(), encode(batch.column("text"))):
                if held and size + len(ids) + 1 > file_ids:
                    yield flush()
                    rows.clear()
                    size = 0
                rows.append(row)
                held.append(ids)
                size += len(ids) + 1
        if held:
            yield flush()

    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).cast("long").alias("id"), body.alias("text"), F.xxhash64(body).alias("tie"), F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange("id", "tie", "row").sortWithinPartitions("id", "tie", "row")
    files = materialise(rows.mapInArrow(write, "path string, n_docs long, n_ids long, id long, tie long, row long"), name="token-manifest")
    before = Window.orderBy(F.col("id").asc_nulls_first(), "tie", "row").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).select(F.lit(folder).alias("folder"), "path", "n_docs", "n_ids", "first_id")


def read_documents(manifest: DataFrame, files: int | None = None) -> DataFrame:
    """One row per document, read back from the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``."""

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder, path, first in zip(batch["folder"], batch["path"], batch["first_id"]):
                with _file_system(folder)[0].open_input_file(path) as source:
                    opened = TokenFile(source)
                    ids = opened.ids().astype("<u4", copy=False)
                    ends = np.cumsum(opened.counts)
                    view = memoryview(ids)
                    crcs = [zlib.crc32(view[e - n : e]) for e, n in zip(ends.tolist(), opened.counts.tolist())]
                    yield pd.DataFrame({"doc_id": pd.array(opened.doc_ids, "Int64"), "start": first + ends - opened.counts, "n_tokens": opened.counts, "ids_crc32": crcs})

    manifest = manifest.repartition(max(1, files or manifest.count()))
    return manifest.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
