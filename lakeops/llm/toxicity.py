"""Toxicity with a bidirectional gated recurrent network over words and characters.

A word enters as a learned vector of its hash next to the mean of learned
vectors of its character n-grams. A word of over 12 bytes is read as several
overlapping pieces, each a word of its own, that hold all its n-grams. Two gated
recurrent layers read a text forwards and backwards and give each word an
attention and a value. Attention pools the values of every 40 words that follow
each other: all overlapping windows of a text, one starting at each word. A
text's score is that of its worst window, mapped to a probability.

Long texts are read in segments; each layer starts ``RUN_IN`` words before the
words it is asked for, from the empty state, so that a word's state hardly
depends on where segments are cut.

The network is trained here, in numpy, on texts that are labelled as a whole:
a toxic text teaches with its worst window, a clean one with its two worst
windows and one at random; which these are is found anew between rounds among
all windows, at first by the log odds of words and n-grams, which also start the
vectors.

Scoring folds vectors and input weights of each distinct word into one row of a
table, so a step of the network is one product of the states, and windows are
sums of their words' weights.

Defined results
- words: ASCII letters in lower case, ASCII punctuation removed, separated by ASCII white space.
  A word of over 12 bytes, with its ends marked, gives pieces of 14 bytes, a new one every 8.
- a null text and one without words have no window and get the least score of the model.
- all windows of the whole text are scored; a text of fewer than 40 words is one window.
- labels of rows in ``fold`` alone are read; repeated ids repeat their labels. Without labels of
  both kinds the score is 0.5 everywhere. An empty table gives an empty result.
- the fit reads about ``toxic`` and ``clean`` rows at most, whole texts of any length; a text gives
  three windows to a round at most.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.features import Adam, labelled_texts, sampled

WINDOW = 40
#: Words that a layer is asked for at once, and words it reads before them.
SEGMENT, RUN_IN = 256, 40
HIDDEN = 8
WORD_ROWS, WORD_SIZE = 1 << 13, 4
GRAM_ROWS, GRAM_SIZE = 1 << 14, 6
GRAM_LENGTHS = (3, 5, 7)
#: Bytes of a piece with its marks, new bytes in each, and its n-grams at most. Pieces share 6 bytes, so each 7-gram is in one.
PIECE, PIECE_STEP = 14, 8
GRAMS = sum(PIECE - n + 1 for n in GRAM_LENGTHS)
AT_ONCE = 2048
KEPT_WORDS = 1 << 18

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def marked(word: bytes) -> bytes:
    """A word with its ends marked; a piece of a long word as it is, which has a mark at an end of the word only."""
    return word if len(word) > PIECE - 2 or word[-1:] == b"$" else b"^" + word + b"$"


def pieces(word: bytes) -> list[bytes]:
    """A word, or the overlapping pieces of a long one."""
    if len(word) <= PIECE - 2:
        return [word]
    chars = b"^" + word + b"$"
    return [chars[i : i + PIECE] for i in range(0, len(chars) - (PIECE - PIECE_STEP), PIECE_STEP)]


def words_of(text: str | None) -> list[bytes]:
    words = (text or "").encode().lower().translate(None, _PUNCTUATION).split()
    return words if max(map(len, words), default=0) <= PIECE - 2 else [p for w in words for p in pieces(w)]


def word_row(word: bytes) -> int:
    return zlib.crc32(word) % WORD_ROWS


def gram_rows(word: bytes) -> list[int]:
    """Rows of all character n-grams (3, 5 and 7 bytes) of a word or piece with its ends marked."""
    chars = marked(word)
    return [zlib.crc32(chars[i : i + n], 1) % GRAM_ROWS for n in GRAM_LENGTHS for i in range(max(n == 3, len(chars) - n + 1))]


class Words:
    """Inputs of distinct words: their row, and the rows and number of their n-grams. Word 0 is padding; so is the last row of n-grams."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.rows, self.grams, self.counts = np.zeros(1, np.uint16), np.full((1, GRAMS), GRAM_ROWS, np.uint16), np.ones(1, np.float32)

    def __len__(self) -> int:
        return len(self.rows)

    def add(self, new: list[bytes]) -> None:
        rows, grams, counts = np.zeros(len(new), np.uint16), np.full((len(new), GRAMS), GRAM_ROWS, np.uint16), np.ones(len(new), np.float32)
        for i, w in enumerate(new):
            self.place[w] = len(self.rows) + i
            g = gram_rows(w)
            rows[i], grams[i, : len(g)], counts[i] = word_row(w), g, len(g)
        self.rows, self.grams, self.counts = np.concatenate([self.rows, rows]), np.concatenate([self.grams, grams]), np.concatenate([self.counts, counts])


class Texts:
    """Some texts as one array of word numbers; ``ends`` has the end of each."""

    def __init__(self, ids: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in ids], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        self.flat = np.concatenate([*ids, np.zeros(1, np.int32)])

    def at(self, places: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Words at places; padding outside of each row's text."""
        inside = (places >= begins[:, None]) & (places < ends[:, None])
        return np.where(inside, self.flat[np.clip(places, 0, len(self.flat) - 1)], 0)

    def windows(self, text: np.ndarray, start: np.ndarray) -> np.ndarray:
        """(windows, 40) words of windows that start at places of texts."""
        return self.at(start[:, None] + np.arange(WINDOW), self.begins[text], self.ends[text])

    def starts(self) -> tuple[np.ndarray, np.ndarray]:
        """How many windows each text has, and where they start: one at each word that 39 others follow, or the whole of a shorter text."""
        count = np.where(self.sizes > 0, np.maximum(1, self.sizes - WINDOW + 1), 0)
        first = np.cumsum(count) - count
        return count, np.repeat(self.begins - first, count) + np.arange(int(count.sum()))


def window_sums(values: np.ndarray) -> np.ndarray:
    """Sums of every 40 values that follow each other, one from each place on (fewer at the end), by doubling: nothing is subtracted."""
    def later(x: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([x[by:], np.zeros(min(by, len(x)), x.dtype)])

    eight = values
    for by in (1, 2, 4):
        eight = eight + later(eight, by)
    all_ = eight
    for by in (8, 16):
        all_ = all_ + later(all_, by)
    return all_ + later(eight, 32)


def of_windows(texts: Texts, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over all windows of all texts, the windows' starts, and the number of each text's."""
    count, start = texts.starts()
    # Texts of fewer than 40 words stand apart, or a window would run into the next text.
    short = np.flatnonzero((texts.sizes > 0) & (texts.sizes < WINDOW))
    sums = window_sums(values)[start] if len(start) else np.zeros(0, values.dtype)
    where = (np.cumsum(count) - count)[short]
    inside = np.arange(WINDOW) < texts.sizes[short][:, None]
    sums[where] = np.where(inside, values[np.minimum(texts.begins[short][:, None] + np.arange(WINDOW), max(0, len(values) - 1))], 0).sum(axis=1)
    return sums, start, count


class Network:
    """The weights and what is done with them. Gates are in the order update, reset, new; both directions are stacked."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def new(cls, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        size = WORD_SIZE + GRAM_SIZE
        shapes = {"word": (WORD_ROWS, WORD_SIZE), "gram": (GRAM_ROWS + 1, GRAM_SIZE), "x": (size, 6 * HIDDEN), "xb": (6 * HIDDEN,), "u": (2, HIDDEN, 3 * HIDDEN), "attend": (2, HIDDEN), "out": (2, HIDDEN), "b": (1,)}
        spread = {"word": 0.05, "gram": 0.05, "x": 0.5, "u": 0.3, "attend": 0.3, "out": 0.5}
        weights = {k: (rng.standard_normal(s) * spread.get(k, 0)).astype(np.float32) for k, s in shapes.items()}
        weights["gram"][GRAM_ROWS] = 0
        return cls(weights)

    def inputs(self, words: Words, some: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Vectors of words."""
        w = self.w
        grams = w["gram"][words.grams[some]].sum(axis=1) / words.counts[some][:, None]
        return np.concatenate([w["word"][words.rows[some]], grams], axis=1)

    def table(self, words: Words, some: np.ndarray | slice = slice(None)) -> np.ndarray:
        """(words, 2, gates) inputs to the gates. Padding closes the update gate, so states pass it unchanged."""
        out = (self.inputs(words, some) @ self.w["x"] + self.w["xb"]).reshape(-1, 2, 3 * HIDDEN)
        pad = np.flatnonzero(np.arange(len(words))[some] == 0)
        out[pad, :, :HIDDEN] = 30
        return out

    def heads(self, table: np.ndarray, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Attention and value of every word of some texts, from the rows of ``table``."""
        segments = -(-texts.sizes // SEGMENT)
        owner = np.repeat(np.arange(len(segments)), segments)
        first = texts.begins[owner] + SEGMENT * (np.arange(len(owner)) - np.repeat(np.cumsum(segments) - segments, segments))
        size = np.minimum(SEGMENT, texts.ends[owner] - first)
        out = np.zeros((2, len(texts.flat) - 1), np.float32)
        order = np.argsort(size, kind="stable")
        both = np.ascontiguousarray(table.transpose(1, 0, 2))
        for k in range(0, len(order), AT_ONCE):
            some = order[k : k + AT_ONCE]
            self._read(both, texts, owner[some], first[some], size[some], out)
        return out[0], out[1]

    def _read(self, both: np.ndarray, texts: Texts, owner: np.ndarray, first: np.ndarray, size: np.ndarray, out: np.ndarray) -> None:
        """Add what both layers give for the words of some segments to ``out``."""
        n, longest = len(first), int(size.max())
        begins, ends = texts.begins[owner], texts.ends[owner]
        steps = np.arange(RUN_IN + longest)
        ahead = np.ascontiguousarray(texts.at(first[:, None] - RUN_IN + steps, begins, ends).T)
        back = np.ascontiguousarray(texts.at((first + size)[:, None] + RUN_IN - 1 - steps, begins, ends).T)
        weights = np.stack([self.w["attend"], self.w["out"]], axis=2)
        h, x = np.zeros((2, n, HIDDEN), np.float32), np.empty((2, n, 3 * HIDDEN), np.float32)
        found = np.empty((2, longest, n, 2), np.float32)
        for t in range(RUN_IN + longest):
            np.take(both[0], ahead[t], axis=0, out=x[0])
            np.take(both[1], back[t], axis=0, out=x[1])
            u = h @ self.w["u"]
            gates = x[..., : 2 * HIDDEN] + u[..., : 2 * HIDDEN]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            new = gates[..., HIDDEN:] * u[..., 2 * HIDDEN :]
            new += x[..., 2 * HIDDEN :]
            np.tanh(new, out=new)
            h -= new
            h *= gates[..., :HIDDEN]
            h += new
            if t >= RUN_IN:
                np.matmul(h, weights, out=found[:, t - RUN_IN])
        step = np.arange(longest)[:, None]
        inside = step < size
        for layer, places in ((0, first + step), (1, first + size - 1 - step)):
            out[:, places[inside]] += found[layer][inside].T

    def windows(self, table: np.ndarray, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of all windows of some texts, where they start, and the number of each text's."""
        attend, value = self.heads(table, texts)
        weight = np.exp(np.clip(attend.astype(np.float64), -60, 60))
        total, start, count = of_windows(texts, weight)
        return of_windows(texts, weight * value)[0] / total + self.w["b"][0], start, count

    def gradients(self, words: Words, ids: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss over some windows, by going back through time."""
        w, n = self.w, len(ids)
        own, inverse = np.unique(ids, return_inverse=True)
        inverse = inverse.reshape(ids.shape)
        vectors, table = self.inputs(words, own), self.table(words, own)
        h, states, kept = np.zeros((2, n, HIDDEN), np.float32), [], []
        for t in range(WINDOW):
            x = np.stack([table[inverse[:, t], 0], table[inverse[:, WINDOW - 1 - t], 1]])
            u = h @ w["u"]
            gates = 1 / (1 + np.exp(-(x[..., : 2 * HIDDEN] + u[..., : 2 * HIDDEN])))
            z, r = gates[..., :HIDDEN], gates[..., HIDDEN:]
            new = np.tanh(x[..., 2 * HIDDEN :] + r * u[..., 2 * HIDDEN :])
            kept.append((h, z, r, new, u[..., 2 * HIDDEN :]))
            h = new + z * (h - new)
            states.append(h)
        s = np.stack(states)  # (steps, directions, windows, hidden)
        s = np.stack([s[:, 0], s[::-1, 1]], axis=1)
        attend, value = (np.einsum("tdnh,dh->tn", s, w[k]) for k in ("attend", "out"))
        attend = np.where(ids.T > 0, attend, -1e9)
        a = np.exp(attend - attend.max(axis=0))
        a /= a.sum(axis=0)
        pooled = (a * value).sum(axis=0)
        slope = (weight * (1 / (1 + np.exp(-(pooled + w["b"][0]))) - label)).astype(np.float32)
        to_value = a * slope
        to_attend = to_value * (value - pooled)
        g = {"attend": np.einsum("tn,tdnh->dh", to_attend, s), "out": np.einsum("tn,tdnh->dh", to_value, s), "b": np.array([slope.sum()], np.float32), "u": np.zeros_like(w["u"])}
        to_s = to_attend[:, None, :, None] * w["attend"][None, :, None, :] + to_value[:, None, :, None] * w["out"][None, :, None, :]
        to_h, to_table = np.zeros((2, n, HIDDEN), np.float32), np.zeros((len(own), 2, 3 * HIDDEN), np.float32)
        for t in reversed(range(WINDOW)):
            h, z, r, new, un = kept[t]
            to_h = to_h + np.stack([to_s[t, 0], to_s[WINDOW - 1 - t, 1]])
            dn = to_h * (1 - z) * (1 - new * new)
            dz = to_h * (h - new) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            to_u = np.concatenate([dz, dr, dn * r], axis=2)
            g["u"] += np.einsum("dnh,dng->dhg", h, to_u)
            to_x = np.concatenate([dz, dr, dn], axis=2)
            np.add.at(to_table[:, 0], inverse[:, t], to_x[0])
            np.add.at(to_table[:, 1], inverse[:, WINDOW - 1 - t], to_x[1])
            to_h = to_h * z + to_u @ w["u"].transpose(0, 2, 1)
        to_table[own == 0] = 0
        flat = to_table.reshape(len(own), -1)
        g["x"], g["xb"] = vectors.T @ flat, flat.sum(axis=0)
        to_vectors = flat @ w["x"].T
        g["word"], g["gram"] = np.zeros_like(w["word"]), np.zeros_like(w["gram"])
        np.add.at(g["word"], words.rows[own], to_vectors[:, :WORD_SIZE])
        np.add.at(g["gram"], words.grams[own], (to_vectors[:, WORD_SIZE:] / words.counts[own][:, None])[:, None, :])
        g["gram"][GRAM_ROWS] = 0
        return g


class Model(NamedTuple):
    network: Network | None
    slope: float
    shift: float

    def score(self, logit: np.ndarray) -> np.ndarray:
        """Probability for the worst window's score."""
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -30, 30)))


NO_WINDOW = -12.0


def _log_odds(texts: Iterator[np.ndarray], label: np.ndarray, size: int) -> np.ndarray:
    """Smoothed log odds of toxic against clean texts that hold each row; one array of rows per text."""
    seen = np.zeros((2, size))
    for rows, y in zip(texts, label):
        seen[int(y), np.unique(rows)] += 1
    return (np.log((seen[1] + 0.5) / (label.sum() + 1)) - np.log((seen[0] + 0.5) / ((1 - label).sum() + 1))).astype(np.float32)


def _worst(scores: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The largest score of each text; ``NO_WINDOW`` without any."""
    out = np.full(len(count), NO_WINDOW)
    some = np.flatnonzero(count)
    if len(some):
        out[some] = np.maximum.reduceat(scores, (np.cumsum(count) - count)[some])
    return out


def _teaching(scores: np.ndarray, start: np.ndarray, count: np.ndarray, toxic: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Texts and starts of the windows that teach: a toxic text's worst, a clean one's two worst, half a window apart, and one at random."""
    texts, chosen = [], []
    for k, end in enumerate(np.cumsum(count)):
        s = scores[end - count[k] : end]
        best = int(s.argmax())
        picked = [best]
        if not toxic[k]:
            rest = s.copy()
            rest[max(0, best - WINDOW // 2) : best + WINDOW // 2] = -np.inf
            second = int(rest.argmax())
            picked += [second] if rest[second] > -np.inf else []
            picked.append(int(rng.integers(len(s))))
        texts += [k] * len(picked)
        chosen += [int(start[end - count[k] + p]) for p in picked]
    return np.array(texts), np.array(chosen)


def fit(texts: list[str], label: np.ndarray, rounds: int = 3, epochs: int = 5, batch: int = 256) -> Model:
    """Train on labelled texts."""
    label = label.astype(np.float32)
    split = [words_of(t) for t in texts]
    label = label[[bool(s) for s in split]]
    split = [s for s in split if s]
    if not 0 < label.sum() < len(label):
        return Model(None, 0.0, 0.0)
    rng, words, network = np.random.default_rng(5), Words(), Network.new()
    words.add(list(dict.fromkeys(w for s in split for w in s)))
    numbers = [np.array([words.place[w] for w in s], np.int32) for s in split]
    del split
    known = Texts(numbers)
    word_odds = _log_odds((words.rows[np.unique(x)] for x in numbers), label, WORD_ROWS)
    gram_odds = _log_odds((words.grams[np.unique(x)].reshape(-1) for x in numbers), label, GRAM_ROWS + 1)
    gram_odds[GRAM_ROWS] = 0
    network.w["word"][:, 0], network.w["gram"][:, 0] = word_odds / 4, gram_odds / 4
    hint = np.concatenate([word_odds[words.rows[k : k + AT_ONCE]] / 2 + gram_odds[words.grams[k : k + AT_ONCE]].sum(axis=1) / words.counts[k : k + AT_ONCE] for k in range(0, len(words), AT_ONCE)])
    scores, start, count = of_windows(known, np.square(np.maximum(0, hint))[known.flat[:-1]])
    steps = Adam(network.w, 0.01)
    for _ in range(rounds):
        owner, chosen = _teaching(scores, start, count, label > 0, rng)
        ids, y = known.windows(owner, chosen), label[owner]
        weigh = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(chosen)
        for _ in range(epochs):
            mixed = rng.permutation(len(chosen))
            for k in range(0, len(mixed), batch):
                some = mixed[k : k + batch]
                g = network.gradients(words, ids[some], y[some], weigh[some] / len(some))
                size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
                steps.step({k2: x * min(1.0, 1 / (size + 1e-9)) for k2, x in g.items()})
        table = np.concatenate([network.table(words, np.arange(k, min(k + AT_ONCE, len(words)))) for k in range(0, len(words), AT_ONCE)])
        scores, start, count = network.windows(table, known)
    most = _worst(scores, count)
    # Two numbers turn the worst window's score into a probability of the text.
    share = np.where(label > 0, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    a, b = np.array([1.0]), np.array([0.0])
    fitted = Adam({"a": a, "b": b}, 0.05)
    for _ in range(400):
        d = share * (1 / (1 + np.exp(-np.clip(a * most + b, -30, 30))) - label)
        fitted.step({"a": np.array([(d * most).sum() + 1e-3 * a[0]]), "b": np.array([d.sum()])})
    return Model(network, float(max(a[0], 0.05)), float(b[0]))


def train(docs: DataFrame, labels: DataFrame, fold: Column, *, id: str = "doc_id", text: str = "text", label: str = "toxic", toxic: int = 2000, clean: int = 2500) -> Model:
    """Fit on labelled documents of the ``fold``."""
    known = labels.where(fold & F.col(label).isin(0, 1)).select(F.col(id), F.col(label).cast("int").alias("_toxic")).distinct()
    chosen = sampled(known.where("_toxic = 1"), toxic, id=id).union(sampled(known.where("_toxic = 0"), clean, id=id))
    rows = labelled_texts(docs, chosen, "_toxic", id=id, text=text).toPandas().sort_values([id, "_toxic", "text"])
    return fit(rows["text"].tolist(), rows["_toxic"].to_numpy())


class Scorer:
    """Scores texts with one model; rows of the table are kept for words already seen."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.table = None if self.model.network is None else self.model.network.table(Words())

    def _learn(self, split: list[list[bytes]]) -> None:
        new = list(dict.fromkeys(w for s in split for w in s if w not in self.place))
        if new and len(self.place) > KEPT_WORDS:
            self._forget()
            new = list(dict.fromkeys(w for s in split for w in s))
        for k in range(0, len(new), AT_ONCE):
            words, old = Words(), len(self.table)
            words.add(new[k : k + AT_ONCE])
            self.place.update((w, old + i - 1) for w, i in words.place.items())
            self.table = np.concatenate([self.table, self.model.network.table(words)[1:]])

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        network = self.model.network
        if network is None:
            return np.full(len(texts), 0.5)
        split = [words_of(t) for t in texts]
        self._learn(split)
        known = Texts([np.fromiter(map(self.place.__getitem__, s), np.int32, len(s)) for s in split])
        scores, _, count = network.windows(self.table, known)
        return self.model.score(_worst(scores, count))


def scored(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``score`` and ``predicted`` (1 from 0.5 on) in place of these names. The model is about 600 KB."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for batch in batches:
            parts = [scorer(batch.iloc[k : k + 500].tolist()) for k in range(0, len(batch), 500)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0), dtype=np.float64)

    udf = F.pandas_udf(score, "double")
    out = docs.drop("score", "predicted").withColumn("score", udf(F.coalesce(F.col(text), F.lit(""))))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
