"""Text features and bounded labelled samples for the trained operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import draw60, key_text, materialise

HASHED = 2048
STATS = 28
#: Texts whose features a task holds at once, and bytes of a text that are counted at once.
TEXTS_AT_ONCE = 512
BYTES_AT_ONCE = 1 << 20


def gram_counts(raw: bytes, size: int = HASHED) -> np.ndarray:
    """Counts of hashed byte trigrams, on a log scale and of length 1; zeros for texts under 3 bytes."""
    if len(raw) < 3:
        return np.zeros(size, np.float32)
    counts = np.zeros(size, np.int64)
    for k in range(0, len(raw) - 2, BYTES_AT_ONCE):
        b = np.frombuffer(raw, np.uint8, min(len(raw) - k, BYTES_AT_ONCE + 2), k).astype(np.uint32)
        h = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        counts += np.bincount((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - (size - 1).bit_length()), minlength=size)
    out = np.log1p(counts).astype(np.float32)
    return out / (np.sqrt((out * out).sum()) + np.float32(1e-9))


def slices(rows):
    """A batch of rows in pieces of ``TEXTS_AT_ONCE``; an empty batch is one piece."""
    return (rows[k : k + TEXTS_AT_ONCE] for k in range(0, max(1, len(rows)), TEXTS_AT_ONCE))


_KIND = np.zeros(256, np.uint8)  # of a byte: 1 space, 2 digit, 3 capital, 4 small letter or part of a non-ASCII one, 5 sentence mark, 6 other
_KIND[33:127] = 6
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 2, 3, 4, 4
_KIND[[ord(c) for c in ".,;:?'\"-"]] = 5


def style(raw: bytes) -> np.ndarray:
    """Shares and ratios that describe how a text is written; zeros for empty text."""
    words = raw.split()
    if not words:
        return np.zeros(STATS, np.float32)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=7) / len(raw)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = len(words)
    same = sum(map(bytes.__eq__, words, words[1:])) / n
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
    # A share of distinct words falls with length even in good prose; the power evens this out.
    rich = min(1.0, len(set(words)) / n**0.9)
    values = np.array([*kinds[1:7], np.log1p(n) / 10, rich, same, 1 - pairs, 1 - len(set(lines)) / len(lines), min(40, len(raw) / n) / 10, raw.count(b"|") / n, sum(map(bytes.isupper, words)) / n], np.float32)
    # Roots tell a small share from none.
    return np.concatenate([values, np.sqrt(values)])


def sampled(rows: DataFrame, bound: int, *, id: str = "doc_id", by: str | None = None) -> DataFrame:
    """About ``bound`` rows at most (of each value of ``by``), chosen by a draw from the id: the same rows in each run, without a sort."""
    rows = rows.withColumn("_unit", draw60(key_text(id), F.lit("|sample")) / F.lit(float(2**60)))
    sizes = materialise(rows.groupBy(*([by] if by else [])).agg(F.count(F.lit(1)).alias("_all")), name="sample-sizes")
    joined = rows.join(sizes, by) if by else rows.withColumn("_all", sizes.select("_all").scalar())
    return joined.where(F.col("_unit") * F.col("_all") < bound).drop("_unit", "_all")


def labelled_texts(docs: DataFrame, chosen: DataFrame, *columns: Column | str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The chosen ids' texts. ``chosen`` is bounded by :func:`sampled`, so it is sent to the scan of the texts."""
    return docs.select(F.col(id).alias(id), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), id).select(id, "text", *columns)


class Adam:
    """Adaptive moment steps for a dict of arrays, in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.t = weights, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in gradients.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.weights[k] -= (self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(self.weights[k].dtype)
