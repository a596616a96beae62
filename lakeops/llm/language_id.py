"""Language identification with error-correcting output codes.

Each language has a codeword. One binary classifier per bit, linear in hashed
byte trigrams of the lower-case text, predicts that bit's sign. Decoding sums
the logistic loss of the classifiers against every codeword, each bit weighted
for each language by how well its classifier does on that language, and takes
the codeword with the least loss. If the runner-up is about as near, the text is
flagged as ambiguous.

Up to 7 languages the code is exhaustive (every way to split them in two);
beyond, the best of many random codes by least distance, 10 bits for each
doubling.

Defined results
- null text and text without a letter are ``und`` with score 0.
- score is the share of the chosen language if losses are read as log odds.
- ties go to the language that comes first by code point.
- with one language learned every text with a letter gets it, with score 1;
  with none, every text is ``und``. An empty table gives an empty result.
- the fit reads about ``per_language`` texts of each language at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.features import HASHED, Adam, gram_counts, sampled, slices

UNKNOWN = "und"
AMBIGUOUS_BELOW = 0.75


class Model(NamedTuple):
    languages: list[str]
    code: np.ndarray  # (languages, bits) of -1 and 1
    weights: np.ndarray  # (features + 1, bits)
    trust: np.ndarray  # (languages, bits), rows sum to 1


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """(n, bits) of -1 and 1; every bit splits the rows."""
    if n < 2:
        return np.ones((n, 1), np.float32)
    if n <= 7:
        splits = np.arange(1, 2 ** (n - 1))
        return np.array([[1.0 if i == 0 or not (s >> (i - 1)) & 1 else -1.0 for s in splits] for i in range(n)], np.float32)
    rng, bits, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None
    for _ in range(300):
        code = rng.choice([-1.0, 1.0], (n, bits))
        apart = ((code[:, None] != code[None]).sum(axis=2) + np.eye(n) * bits).min()
        if (np.abs(code.sum(axis=0)) < n).all() and (best is None or apart > best[0]):
            best = (apart, code)
    return best[1].astype(np.float32)


def features(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), HASHED), np.float32)
    for row, text in zip(out, texts):
        row[:] = gram_counts(text.lower().encode())
    return out


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)


def fit(x: np.ndarray, languages: list[str], target: np.ndarray, epochs: int = 60) -> Model:
    """Fit all bits at once by logistic loss; ``target`` holds places in ``languages``. Languages weigh alike."""
    code = codewords(len(languages))
    weights = np.zeros((HASHED + 1, code.shape[1]), np.float32)
    if len(languages) < 2:
        return Model(languages, code, weights, np.ones_like(code))
    x, sign = _with_one(x), code[target]
    weigh = (1 / np.bincount(target, minlength=len(languages)))[target][:, None] / len(languages)
    steps = Adam({"w": weights}, 0.3)
    for _ in range(epochs):
        slope = -sign / (1 + np.exp(np.clip(sign * (x @ weights), -30, 30)))
        steps.step({"w": (x.T @ (slope * weigh)).astype(np.float32) + 1e-5 * weights})
    right = ((x @ weights) * sign > 0).astype(np.float64)
    trust = np.stack([right[target == k].mean(axis=0) for k in range(len(languages))]) + 1e-6
    return Model(languages, code, weights, (trust / trust.sum(axis=1, keepdims=True)).astype(np.float32))


def decode(model: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest codeword, and its share."""
    margins = _with_one(x) @ model.weights
    loss = np.logaddexp(0, -margins[:, None, :] * model.code[None]) * model.trust[None]
    odds = -loss.sum(axis=2) * model.code.shape[1]
    odds = np.exp(odds - odds.max(axis=1, keepdims=True))
    return odds.argmax(axis=1), odds.max(axis=1) / odds.sum(axis=1)


def train(docs: DataFrame, fold: Column, *, id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 800) -> Model:
    """Fit on documents of the ``fold`` whose language is known."""

    def to_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (some for whole in batches for some in slices(whole)):
            x = features(batch["text"].tolist()).astype(np.float16)
            yield pd.DataFrame({"lang": batch["lang"], "draw": batch["draw"], "x": [r.tobytes() for r in x]})

    known = docs.where(fold & F.col(lang).isNotNull()).select(F.col(id).alias("id"), F.col(lang).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = sampled(known, per_language, id="id", by="lang").select("lang", F.xxhash64("id").alias("draw"), "text")
    rows = rows.mapInPandas(to_rows, "lang string, draw long, x binary").toPandas().sort_values(["lang", "draw", "x"])
    languages = sorted(rows["lang"].unique())
    x = np.frombuffer(b"".join(rows["x"]), np.float16).reshape(-1, HASHED).astype(np.float32)
    return fit(x, languages, rows["lang"].map({l: i for i, l in enumerate(languages)}).to_numpy(dtype=np.int64))


def identified(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred``, ``score`` and ``ambiguous`` in place of any of these names. The model is small: bits times features."""

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.concat([named(texts) for texts in slices(batch.tolist())], ignore_index=True)

    def named(texts: list[str]) -> pd.DataFrame:
        some = [bool(model.languages) and any(map(str.isalpha, t)) for t in texts]
        place, share = decode(model, features(texts)) if model.languages and texts else (np.zeros(len(texts), int), np.zeros(len(texts)))
        names = [model.languages[k] if s else UNKNOWN for k, s in zip(place, some)]
        score = np.where(some, share, 0.0).astype(np.float64)
        return pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": score, "ambiguous": score < AMBIGUOUS_BELOW})

    udf = F.pandas_udf(predict, "lang_pred string, score double, ambiguous boolean")
    out = docs.drop("lang_pred", "score", "ambiguous").withColumn("_found", udf(F.coalesce(F.col(text), F.lit(""))))
    return out.select("*", "_found.*").drop("_found")
