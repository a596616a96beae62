"""Quality classifier from trusted positives and unlabelled text.

The model is linear in hashed byte trigrams and measures of style. It is fitted
by the non-negative unbiased risk: with class prior p, positives P and unlabelled
text U, the risk of the negative class is estimated as R_U(-) - p R_P(-) and
never let below 0; when a batch's estimate is, the step climbs back. The prior
is estimated from the data: a first classifier separates P from U; among texts
it was not fitted on, the least ratio of the share of U above a score to that
of P, with a margin for small counts, bounds the share of positives in U. Last,
the bias is set so that the share of unseen unlabelled texts at the threshold or
above equals the prior; no label of a bad text is needed for that.

Defined results
- a null or empty text has all features 0 and a score like any other text.
- labels of the rows given as ``fold`` alone are read; label 0 counts as unlabelled.
- without positives or without texts the score is 0.5 everywhere.
- repeated ids repeat their labels; an empty table gives an empty result.
- the fit reads about ``positives`` and ``unlabelled`` rows at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.features import HASHED, STATS, Adam, gram_counts, labelled_texts, sampled, slices, style

THRESHOLD = 0.7


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def features(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), HASHED + STATS), np.float32)
    for row, text in zip(out, texts):
        raw = (text or "").encode()
        row[:HASHED], row[HASHED:] = gram_counts(raw), style(raw)
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimated_prior(p: np.ndarray, u: np.ndarray) -> float:
    """The share of positives in unlabelled text, from scores of unseen positives and unseen unlabelled texts."""
    cuts = np.unique(np.quantile(p, np.linspace(0.02, 0.98, 97)))
    above_p, above_u = (np.array([(x >= c).mean() for c in cuts]) for x in (p, u))
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(u)) + above_u / np.maximum(above_p, 1e-9) / np.sqrt(len(p)))
    best = int(np.argmin((above_u + margin) / np.maximum(above_p, 1e-9)))
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.98))


def _fit(p: np.ndarray, u: np.ndarray, prior: float | None, epochs: int = 120, batch: int = 512, decay: float = 2e-4) -> tuple[np.ndarray, float]:
    """Logistic fit of P against U (no prior) or by non-negative PU risk."""
    rng = np.random.default_rng(7)
    w = {"w": np.zeros(p.shape[1], np.float32), "b": np.zeros(1, np.float32)}
    if prior is not None:
        w["b"][0] = np.log(prior / (1 - prior))
    steps = Adam(w, 0.03)
    for _ in range(epochs):
        order = rng.permutation(len(u))
        for k in range(0, len(u), batch):
            xu = u[order[k : k + batch]]
            at = int(rng.integers(0, max(1, len(p) - batch + 1)))
            xp = p[at : at + batch]
            sp, su = _sigmoid(xp @ w["w"] + w["b"]), _sigmoid(xu @ w["w"] + w["b"])
            if prior is None:
                gp, gu = (sp - 1) / len(xp), su / len(xu)
            else:
                # The loss of a wrong side is the log loss: its slope is s - 1 for label 1 and s for label 0.
                negative = -np.log(np.maximum(1 - su, 1e-7)).mean() + prior * np.log(np.maximum(1 - sp, 1e-7)).mean()
                gp, gu = prior * (sp - 1) / len(xp) - prior * sp / len(xp), su / len(xu)
                if negative < 0:
                    gp, gu = prior * sp / len(xp), -su / len(xu)
            steps.step({"w": xp.T @ gp + xu.T @ gu + decay * w["w"], "b": np.array([gp.sum() + gu.sum()], np.float32)})
    return w["w"], float(w["b"][0])


def fit(x: np.ndarray, positives: int) -> Model:
    """Estimate the prior on one half of the rows from a fit on the other, then fit by PU risk on all.

    The first ``positives`` rows are trusted, the others unlabelled. ``x`` is normalised in place.
    """
    width = HASHED + STATS
    if not 0 < positives < len(x):
        return Model(np.zeros(width, np.float32), 0.0, np.zeros(width, np.float32), np.ones(width, np.float32), 0.5)
    mean, scale = x.mean(axis=0), x.std(axis=0) + np.float32(1e-3)
    # Trigrams are many and each says little; they share the weight of the measures of style.
    scale[:HASHED] *= 60
    x -= mean
    x /= scale
    np.clip(x, -6, 6, out=x)
    p, u = x[:positives], x[positives:]
    w, b = _fit(p[::2], u[::2], None, epochs=30)
    seen_p, seen_u = (p[1::2], u[1::2]) if len(p) > 1 and len(u) > 1 else (p, u)
    prior = estimated_prior(_sigmoid(seen_p @ w + b), _sigmoid(seen_u @ w + b))
    # A quarter of the unlabelled texts stays unseen and sets the bias.
    unseen = np.arange(len(u)) % 4 == 0 if len(u) >= 8 else np.ones(len(u), bool)
    w, b = _fit(p, u[~unseen] if len(u) >= 8 else u, prior)
    cut = np.quantile(u[unseen] @ w + b, 1 - prior)
    return Model(w, float(b + np.log(THRESHOLD / (1 - THRESHOLD)) - cut), mean, scale, prior)


def train(docs: DataFrame, labels: DataFrame, fold: Column, *, id: str = "doc_id", text: str = "text", label: str = "quality", positives: int = 2500, unlabelled: int = 5000) -> Model:
    """Fit on documents of the ``fold``: those labelled 1, and text without a look at labels."""

    def to_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (some for whole in batches for some in slices(whole)):
            x = features(batch["text"].tolist()).astype(np.float16)
            yield pd.DataFrame({"kind": batch["kind"], "draw": batch["draw"], "x": [r.tobytes() for r in x]})

    trusted = sampled(labels.where(fold & (F.col(label) == 1)).select(id).distinct(), positives, id=id).withColumn("kind", F.lit(1))
    drawn = F.xxhash64(F.col(id)).alias("draw")
    a = labelled_texts(docs, trusted, "kind", drawn, id=id, text=text)
    b = sampled(docs.where(fold).select(id, text), unlabelled, id=id).select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.lit(0).alias("kind"), drawn)
    rows = a.select("text", "kind", "draw").union(b).mapInPandas(to_rows, "kind int, draw long, x binary").toPandas().sort_values(["kind", "draw", "x"], ascending=[False, True, True])
    x = np.frombuffer(b"".join(rows["x"]), np.float16).reshape(-1, HASHED + STATS).astype(np.float32)
    return fit(x, int(rows["kind"].sum()))


def scored(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``score``, ``predicted`` (1 from 0.7 on) in place of any of these names. The model is a few KB."""
    kept = docs.drop("score", "predicted")

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.concatenate([model.score(features(texts)) for texts in slices(batch.tolist())]).astype(np.float64))

    udf = F.pandas_udf(score, "double")
    return kept.withColumn("score", udf(F.coalesce(F.col(text), F.lit("")))).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
