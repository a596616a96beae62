"""Product codes of vectors, with a geometric near-neighbour tree over each codebook.

A vector becomes integers and is cut into parts; a part's code is the nearest of
a small codebook. Codebooks are fitted in rounds: one pass over the vectors
assigns every part and sums the parts of each entry, Spark adds the sums up, and
only one row per part, entry and component reaches the driver.

The nearest entry is found in a tree (:class:`Gnat`). A node holds a few split
points, and gives every other entry to its nearest split. For each pair (i, j) it
stores the least and the largest distance from split i to the entries under
split j. A query that is at distance d from split i, with a best distance r so
far, skips everything under j if the range lies wholly outside [d - r, d + r].
The comparison is strict and distances are rounded outwards, so an entry as near
as the best one is never skipped; the winner is told by exact integer distances,
ties going to the lower index.

Defined results
- rows whose vector is null, or holds a null or a component that is not finite, are dropped;
  so are vectors of another length than that of the least kept id, or of a length that the parts do not divide.
- a component x is floor(4096 * x), exactly, however large; beyond what 64-bit distances hold, Python's integers are used.
- the first entries are the vectors of the least ids, a null id last; repeated ids are rows like others, and
  the least vector comes first. With fewer rows than entries, there are as many entries as rows.
- repeated vectors and ties are coded alike. ``error`` beyond a long is the largest long.
- ``label_error`` adds the errors of equal labels, nulls being one label. An empty table gives an empty result;
  other columns are not carried.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import materialise

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Split points of a node.
DEGREE = 4
#: Outward rounding of distances: far above the error of a conversion, a root and a sum.
SLACK = 1e-14
LONGEST = 2**63 - 1


def integers(x: np.ndarray) -> np.ndarray:
    """floor(4096 * x), as 64-bit integers where their squared distances fit, else as Python's."""
    if not x.size or x.shape[-1] * (2 * (np.abs(x).max() * SCALE + 1)) ** 2 < 2.0**61:
        return np.floor(x * SCALE).astype(np.int64)
    flat = [math.floor(v * SCALE) if abs(v) < 2.0**60 else int(v) * SCALE for v in x.reshape(-1).tolist()]
    most = max(map(abs, flat))
    return np.array(flat, np.int64 if x.shape[-1] * (2 * most) ** 2 < 2**62 else object).reshape(x.shape)


def squared(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """(queries, points) exact squared distances."""
    if object in (queries.dtype, points.dtype):
        queries, points = queries.astype(object), points.astype(object)
    d = queries[:, None, :] - points[None, :, :]
    return (d * d).sum(axis=2)


def rounded(square: np.ndarray, way: int) -> np.ndarray:
    """Distances from squares, rounded down (-1) or up (1)."""
    return np.sqrt(square.astype(np.float64)) * (1 + way * SLACK)


class Gnat:
    """A tree over some entries of a codebook (``rows`` of ``points``)."""

    def __init__(self, points: np.ndarray, rows: np.ndarray | None = None):
        rows = np.arange(len(points)) if rows is None else rows
        # Splits far from each other: each next one is the entry farthest from those taken.
        taken, near = [0], squared(points[rows], points[rows[:1]])[:, 0]
        while len(taken) < min(DEGREE, len(rows)):
            taken.append(int(max((k for k in range(len(rows)) if k not in taken), key=lambda k: (near[k], -k))))
            near = np.minimum(near, squared(points[rows], points[rows[taken[-1:]]])[:, 0])
        self.splits = rows[sorted(taken)]
        self.points = points[self.splits]
        rest = np.setdiff1d(rows, self.splits)
        owner = squared(points[rest], self.points).argmin(axis=1) if len(rest) else np.zeros(0, np.int64)
        self.children: list[tuple[int, Gnat]] = []
        self.low, self.high = np.zeros((len(self.splits),) * 2), np.zeros((len(self.splits),) * 2)
        for j in range(len(self.splits)):
            if len(under := rest[owner == j]):
                away = squared(self.points, points[under])
                self.low[:, j], self.high[:, j] = rounded(away.min(axis=1), -1), rounded(away.max(axis=1), 1)
                self.children.append((j, Gnat(points, under)))

    def search(self, queries: np.ndarray, at: np.ndarray, best: np.ndarray, index: np.ndarray, seen: np.ndarray | None = None) -> None:
        """Improve ``best`` (squared distance) and ``index`` of the queries ``at``; ``seen`` counts distances taken."""
        away = squared(queries[at], self.points)
        if seen is not None:
            seen[at] += len(self.splits)
        for j, row in enumerate(self.splits):
            d = away[:, j]
            nearer = (d < best[at]) | ((d == best[at]) & (row < index[at]))
            best[at[nearer]], index[at[nearer]] = d[nearer], row
        least, most = rounded(away, -1), rounded(away, 1)
        for j, child in self.children:
            radius = rounded(best[at], 1)[:, None]
            out = ((least - radius > self.high[:, j]) | (most + radius < self.low[:, j])).any(axis=1)
            if not out.all():
                child.search(queries, at[~out], best, index, seen)


def nearest(tree: Gnat, queries: np.ndarray, seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each query's nearest entry."""
    exact = object in (queries.dtype, tree.points.dtype)
    best = np.full(len(queries), 2**4096 if exact else LONGEST, object if exact else np.int64)
    index = np.full(len(queries), np.iinfo(np.int64).max, np.int64)
    if exact:
        best = squared(queries, tree.points[:1])[:, 0]
        index[:] = tree.splits[0]
    tree.search(queries, np.arange(len(queries)), best, index, seen)
    return index, best


def _parts(x: np.ndarray, parts: int) -> list[np.ndarray]:
    whole = integers(x)
    return np.split(whole, parts, axis=1)


def _matrix(column: pa.ChunkedArray | pa.Array, length: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, length)


def kept_vectors(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``label`` and ``x`` (doubles) of the rows whose vector is whole and finite."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return vectors.where(F.col(vector).isNotNull() & ~bad).select(F.col(id).alias("vec_id"), F.col(label).alias("label"), x.alias("x"))


def fit(rows: DataFrame, length: int, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of each part. Each round is one pass; parts x entries x components sums reach the driver."""
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").toPandas()["x"]
    books = _parts(np.array([np.asarray(x, np.float64) for x in seeds]), parts)
    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], books: list = books) -> Iterator[pa.RecordBatch]:
            trees = [Gnat(b) for b in books]
            total = [np.zeros(b.shape, object) for b in books]
            count = [np.zeros(len(b), np.int64) for b in books]
            for batch in batches:
                for p, x in enumerate(_parts(_matrix(batch.column("x"), length), parts)):
                    index, _ = nearest(trees[p], x)
                    count[p] += np.bincount(index, minlength=len(books[p]))
                    for e in np.unique(index):
                        total[p][e] += x[index == e].sum(axis=0)
            found = [(p, e, k, str(total[p][e, k]), int(count[p][e])) for p in range(parts) for e in np.flatnonzero(count[p]).tolist() for k in range(total[p].shape[1])]
            columns = list(zip(*found)) if found else [[]] * 5
            types = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "entry", "component", "total", "n"])

        made = rows.select("x").mapInArrow(sums, "part int, entry int, component int, total string, n long")
        added = made.groupBy("part", "entry", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).toPandas()
        new = [b.astype(object) for b in books]
        for part, entry, component, total, n in added.itertuples(index=False):
            new[part][entry, component] = int(total) // int(n)
        small = all(length * (2 * max(map(abs, b.reshape(-1)), default=0)) ** 2 < 2**62 for b in new)
        books = [b.astype(np.int64) for b in new] if small else new
    return books


def digest(books: list[np.ndarray]) -> str:
    """sha256 of all components by part, entry and place, as decimal numbers."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.reshape(-1)).encode()).hexdigest()


def coded(rows: DataFrame, books: list[np.ndarray], length: int) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits a part) and ``error`` of every row. The codebooks are a few KB."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch in batches:
            index, error = zip(*[nearest(t, x) for t, x in zip(trees, _parts(_matrix(batch.column("x"), length), len(books)))])
            digits = np.stack(index, axis=1).astype(np.uint8).tobytes().hex()
            width = 2 * len(books)
            total = [min(int(e), LONGEST) for e in sum(e.astype(object) for e in error)]
            codes = [digits[k : k + width] for k in range(0, len(digits), width)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(total, pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: ``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``."""
    if not 0 < entries <= 256:
        raise ValueError("a part's code is two hex digits: 1 to 256 entries")
    kept = kept_vectors(vectors, id=id, vector=vector, label=label)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(1).select(F.size("x").alias("n")).toPandas()["n"].tolist()
    length = first[0] if first and first[0] and first[0] % parts == 0 else 0
    if not length:
        books: list[np.ndarray] = []
        rows = kept.where("false").select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        kept = kept.where(F.size("x") == length)
        books = fit(kept, length, parts=parts, entries=entries, rounds=rounds)
        rows = materialise(coded(kept, books, length), name="vector-codes")
    by_label = rows.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"))
    total = F.least("_sum", F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
    out = rows.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return out.select(F.col("vec_id").alias(id), "code", "error", total.alias("label_error"), F.lit(digest(books)).alias("codebooks_sha256"))
