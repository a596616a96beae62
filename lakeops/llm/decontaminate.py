"""Benchmark decontamination with a BM25 index of test items and block-max WAND.

Test items are cut into pieces of at most 40 words; a long item has several,
which overlap by half. The index holds, per term, the pieces that contain it in
order of piece, with the term's BM25 weight in the piece over the piece's score
against itself, and the largest weight of each block of 8 postings. Every passage of
every training text (64 words, a new one every 32) is a query. A passage whose
terms' largest weights in a run of pieces cannot reach the threshold is done with
that run at once; for the rest, cursors move through the postings, the pivot is the first piece that the largest
weights can carry over the threshold, and a block whose maxima cannot is skipped
whole. All pieces at or above the threshold are retrieved, with no limit on
their number.

Each retrieved (text, item) is then verified on the words around the passages:
the item's 5-word shingles, and those of its question and of its answer's words,
must be found there, and one place where they are is enough. Without own columns the last sentence of an item is its
answer, or its last quarter if it is one sentence.

Test items are the small side. Their bytes are summed before any is fetched;
beyond ``INDEX_BYTES`` they are indexed in several parts, each with its own pass
over the texts, so that no task holds more. Document frequencies and the mean
length of pieces are then counted over all items first, so that each part scores
as one index of all would.

Defined results
- words: lower-case A-Z, without ASCII punctuation, separated by ASCII white
  space. Null and empty texts and items match nothing. Items with fewer than 5
  words are one shingle.
- repeated items count as items of their own; repeated rows of texts give repeated rows.
- document frequencies and mean length are those of the pieces of all items.
- a row is (id, item id, best score, best overlaps, first word of the passage with the best
  score), of the passages that pass verification; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import key_text, materialise

PASSAGE, STEP = 64, 32
#: Passages of a long text whose bounds are held at once, 4 KB each.
PASSAGES_AT_ONCE = 2048
PIECE = 40
SHINGLE = 5
THRESHOLD = 0.55
OVERLAP = 0.75
K1, B = 1.2, 0.75
POSTING_BLOCK = 8
GROUPS = 32
INDEX_BYTES = 32_000_000
DONE = 1 << 60

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(None, _PUNCTUATION).split()


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    """Distinct 5-word shingles; fewer words are one shingle."""
    if not words:
        return set()
    return set(zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else {tuple(words)}


def question_and_answer(text: str) -> tuple[str, str]:
    """All but the last sentence, and the last sentence; of one sentence, its first three quarters and the rest."""
    body = " ".join(text.split())
    cut = max(body.rstrip(".!? ").rfind(mark) for mark in (". ", "! ", "? ")) + 1
    if cut > 0 and body[cut:].strip(".!? ") and len(body[:cut].split()) >= SHINGLE:
        return body[:cut], body[cut:]
    words = body.split(" ")
    cut = max(1, len(words) * 3 // 4)
    return " ".join(words[:cut]), " ".join(words[cut:])


class Item:
    """What verification needs of one test item."""

    def __init__(self, name, text: str | None, question: str | None = None, answer: str | None = None):
        self.name = name
        if question is None and answer is None:
            question, answer = question_and_answer(text or "")
        self.words = words_of(text) if text is not None else words_of(question) + words_of(answer)
        self.shingles, self.question, self.answer = shingles(self.words), shingles(words_of(question)), set(words_of(answer))

    def overlaps(self, words: list[bytes]) -> tuple[float, float, float]:
        """Shares of the item's shingles, of the question's and of the answer's words that ``words`` hold."""
        there, single = shingles(words), set(words)
        share = lambda own, found: len(own & found) / len(own) if own else 1.0
        if len(self.words) < SHINGLE:
            near = len(self.words)
            there = set(zip(*(words[i:] for i in range(near)))) if near else set()
        return share(self.shingles, there), share(self.question, there) if len(self.question) and len(next(iter(self.question))) == SHINGLE else share(self.shingles, there), share(self.answer, single)


def pieces_of(words: list[bytes]) -> list[list[bytes]]:
    """The overlapping pieces of an item."""
    return [words[at : at + PIECE] for at in range(0, max(1, len(words) - PIECE // 2), PIECE // 2) if words]


class Index:
    """BM25 postings of item pieces, for retrieval of all pieces above a threshold.

    Pieces are numbered by length and fall into ``GROUPS`` runs. ``most`` holds the
    largest weight of each term in each run, so that a run which no passage of a
    text can reach costs one column of a matrix. ``counted`` has the number of
    pieces, of their words and of the pieces with each term where ``items`` are a part of all.
    """

    def __init__(self, items: list[Item], counted: tuple[int, int, dict[bytes, int]] | None = None):
        self.items = items
        pieces = [(k, piece) for k, item in enumerate(items) for piece in pieces_of(item.words)]
        pieces.sort(key=lambda x: (len(x[1]), x[0]))
        self.item_of = [k for k, _ in pieces]
        counts = [Counter(w) for _, w in pieces]
        df = Counter(t for c in counts for t in c)
        n_all, n_words, df_all = counted or (len(pieces), sum(len(w) for _, w in pieces), df)
        mean = n_words / max(1, n_all)
        idf = {t: np.log(1 + (n_all - df_all[t] + 0.5) / (df_all[t] + 0.5)) for t in df}
        self.terms: dict[bytes, int] = {t: i for i, t in enumerate(df)}
        self.most = np.zeros((len(df) + 1, GROUPS), np.float32)  # the last row is for words of no item
        postings: list[dict[int, list[tuple[int, float]]]] = [defaultdict(list) for _ in range(GROUPS)]
        for p, ((_, w), count) in enumerate(zip(pieces, counts)):
            weight = {t: idf[t] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(w) / mean)) for t, n in count.items()}
            whole, group = sum(weight.values()), p * GROUPS // len(pieces)
            for t, x in weight.items():
                term = self.terms[t]
                postings[group][term].append((p, x / whole))
                self.most[term, group] = max(self.most[term, group], x / whole)
        self.postings = [{t: self._blocked(x) for t, x in group.items()} for group in postings]

    @staticmethod
    def _blocked(postings: list[tuple[int, float]]) -> tuple[list[int], list[float], list[float], float]:
        """Pieces, weights, the largest weight of each block, and of all."""
        weights = [w for _, w in postings]
        most = [max(weights[i : i + POSTING_BLOCK]) for i in range(0, len(weights), POSTING_BLOCK)]
        return [p for p, _ in postings], weights, most, max(most)

    def bounds(self, ids: np.ndarray) -> np.ndarray:
        """(passages, groups): what the distinct terms of each passage can score at most in each group."""
        n = len(ids)
        blocks = -(-n // STEP)
        padded = np.full(blocks * STEP, len(self.terms), np.int64)
        padded[:n] = ids
        order = np.argsort(padded, kind="stable")
        before = np.full(len(padded), -1, np.int64)
        same = padded[order[1:]] == padded[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        start = np.arange(len(padded)) // STEP * STEP
        weights = self.most[padded].reshape(blocks, STEP, GROUPS)
        head = np.einsum("bt,btg->bg", (before < start).reshape(blocks, STEP).astype(np.float32), weights)
        tail = np.einsum("bt,btg->bg", (before < start - STEP).reshape(blocks, STEP).astype(np.float32), weights)
        return head if blocks == 1 else head[:-1] + tail[1:]

    def hopeful(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """(passage, group) pairs that may reach the threshold; the bounds of some passages of a long text at a time."""
        passages = max(1, -(-len(ids) // STEP) - 1)
        for first in range(0, passages, PASSAGES_AT_ONCE):
            last = min(passages, first + PASSAGES_AT_ONCE)
            some = self.bounds(ids[first * STEP : (last + 1) * STEP])
            for passage, group in zip(*(x.tolist() for x in np.nonzero(some >= THRESHOLD - 1e-5))):
                yield first + passage, group

    def search(self, terms: list[int], group: int, threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """(piece, score) of all pieces of a group that reach the threshold, by block-max WAND over distinct terms."""
        found = []
        cursors = [[x[0][0], 0, x] for x in map(self.postings[group].get, terms) if x]  # piece, place, postings
        enough = threshold - 1e-6
        while True:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                if c[0] == DONE:
                    break
                bound += c[2][3]
                if bound >= enough:
                    pivot = i
                    break
            if pivot < 0:
                return found
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            # Blocks that could hold the pivot: their maxima bound every piece up to the first block end.
            bound, until = 0.0, DONE
            for c in cursors[: pivot + 1]:
                own, _, most, _ = c[2]
                k = c[1] // POSTING_BLOCK
                while k < len(most) and own[min(len(own), (k + 1) * POSTING_BLOCK) - 1] < target:
                    k += 1
                if k < len(most):
                    bound += most[k]
                    until = min(until, own[min(len(own), (k + 1) * POSTING_BLOCK) - 1])
            if bound < enough:
                ahead = cursors[pivot + 1][0] if pivot + 1 < len(cursors) else DONE
                self._advance(cursors[: pivot + 1], min(until + 1, ahead))
            elif cursors[0][0] == target:
                score = sum(c[2][1][c[1]] for c in cursors[: pivot + 1])
                if score >= enough:
                    found.append((target, score))
                self._advance(cursors[: pivot + 1], target + 1)
            else:
                self._advance([c for c in cursors[:pivot] if c[0] < target], target)

    def _advance(self, cursors: list[list], to: int) -> None:
        """Move cursors to the first piece at or after ``to``, block by block."""
        for c in cursors:
            own, at = c[2][0], c[1]
            while at < len(own) and own[min(len(own), (at // POSTING_BLOCK + 1) * POSTING_BLOCK) - 1] < to:
                at = (at // POSTING_BLOCK + 1) * POSTING_BLOCK
            while at < len(own) and own[at] < to:
                at += 1
            c[0], c[1] = (own[at], at) if at < len(own) else (DONE, at)

    def matches(self, words: list[bytes]) -> list[tuple]:
        """(item, score, item overlap, question overlap, answer overlap, first word) of all verified items in one text."""
        n = len(words)
        if not n or not self.items:
            return []
        none = len(self.terms)
        ids = np.fromiter((self.terms.get(w, none) for w in words), np.int64, n)
        places: dict[int, dict[int, float]] = defaultdict(dict)  # of an item: first words of passages and their best scores
        for passage, group in self.hopeful(ids):
            s = passage * STEP
            for piece, score in self.search(list(set(ids[s : s + PASSAGE].tolist())), group):
                found = places[self.item_of[piece]]
                found[s] = max(score, found.get(s, 0.0))
        out = []
        for k, found in places.items():
            item = self.items[k]
            around = max(PASSAGE, len(item.words))
            passing = []
            for s, score in found.items():
                shares = item.overlaps(words[max(0, s - around) : s + PASSAGE + around])
                if shares[0] >= OVERLAP or min(shares[1:]) >= OVERLAP:
                    passing.append((score, -s, shares))
            if passing:
                score, at, _ = max(passing)
                out.append((item.name, score, *max(shares for *_, shares in passing), -at))
        return out


def _parts(items: DataFrame, id: str) -> list[DataFrame]:
    """The items in parts of at most about ``INDEX_BYTES``, by a hash of their id."""
    text = F.concat_ws(" ", *[F.col(c) for c in items.columns if c != id])
    total = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = -(-int(total) * 5 // (INDEX_BYTES * 4)) or 1
    return [items] if n == 1 else [items.where(F.pmod(F.xxhash64(key_text(id), text), F.lit(n)) == k) for k in range(n)]


def _counted(items: DataFrame) -> DataFrame:
    """(``term``, ``n``, ``words``): pieces with each term; of the empty term, all pieces and their words."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pieces = [p for row in batch.itertuples(index=False) for p in pieces_of(Item(*row).words)]
            terms = Counter(t for p in pieces for t in set(p))
            yield pd.DataFrame([(b"", len(pieces), sum(map(len, pieces))), *((t, n, 0) for t, n in terms.items())], columns=["term", "n", "words"])

    rows = items.withColumn("item", F.lit(None).cast("string")).mapInPandas(count, "term binary, n long, words long")
    return rows.groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))


def leaks(docs: DataFrame, items: DataFrame, *, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per text and test item found in it: ids, ``score``, ``item_overlap``, ``question_overlap``, ``answer_overlap``, ``first_word``.

    Items may have columns ``question`` and ``answer``; otherwise ``item_text`` is split.
    """
    if {"question", "answer"} <= set(items.columns):
        items = items.select(F.col(item_id).alias("item"), F.lit(None).cast("string").alias("text"), "question", "answer")
    else:
        items = items.select(F.col(item_id).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"), F.lit(None).cast("string").alias("question"), F.lit(None).cast("string").alias("answer"))
    kind = items.schema["item"].dataType.simpleString()
    kept = docs.select(F.col(id).alias("doc"), F.col(text).alias("text"))
    out, parts = None, _parts(items, "item")
    every = materialise(_counted(items), name="item-terms") if len(parts) > 1 else None
    for part in parts:
        rows = sorted(part.collect(), key=lambda r: (r.item is None, r.item, r.text or ""))
        counted = None
        if every is not None:
            # Only the part's own terms come to the driver; its bytes bound them.
            terms = {bytes(r.term): (r.n, r.words) for r in every.join(_counted(part).select("term"), "term", "left_semi").collect()}
            counted = (*terms.pop(b"", (0, 0)), {t: n for t, (n, _) in terms.items()})
        index = docs.sparkSession.sparkContext.broadcast(([tuple(r) for r in rows], counted))

        def find(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            given, counted = index.value
            held = Index([x for x in (Item(*r) for r in given) if x.words], counted)
            names = ["doc", "item", "score", "item_overlap", "question_overlap", "answer_overlap", "first_word"]
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch["doc"], batch["text"]) for m in held.matches(words_of(t))]
                yield pd.DataFrame(rows, columns=names, dtype=object)

        found = kept.withColumn("doc", F.col("doc").cast("string")).mapInPandas(find, f"doc string, item {kind}, score double, item_overlap double, question_overlap double, answer_overlap double, first_word long")
        out = found if out is None else out.union(found)
    return out.select(F.col("doc").cast(docs.schema[id].dataType).alias(id), F.col("item").alias(item_id), "score", "item_overlap", "question_overlap", "answer_overlap", "first_word")


def clean_rows(docs: DataFrame, items: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` in whose text no test item was found, with its columns. Rows are told apart by id and a hash of the text."""
    key = F.xxhash64(key_text(id), F.coalesce(F.col(text), F.lit("")))
    keyed = docs.select(key.cast("string").alias("_key"), F.col(text).alias("text"))
    dirty = materialise(leaks(keyed, items, id="_key").select(F.col("_key").cast("long").alias("_dirty")).distinct(), name="leaks")
    return docs.withColumn("_key", key).join(dirty, F.col("_key") == F.col("_dirty"), "left_anti").drop("_key")
