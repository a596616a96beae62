"""The Jaccard join against all pairs of documents."""

import re

import numpy as np
import pytest

from lakeops.llm import jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(id, n, component) of (id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[top(i)] = top(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted(((i, len(s), None if i is None else least[top(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def joined(spark, docs_of, rows, parts=4):
    return sorted((tuple(r) for r in J.jaccard_components(docs_of(rows).repartition(parts)).collect()), key=str)


def families(seed, groups=6, copies=14, size=90):
    """Groups of near copies on both sides of the threshold, cousins, and texts that share a long passage but little else."""
    rng = np.random.default_rng(seed)
    vocabulary = np.array([f"w{k}" for k in range(3000)])
    out = []
    for g in range(groups):
        base = rng.choice(vocabulary, size)
        if g % 2:
            base = np.concatenate([base[: size // 3], last[size // 3 :]])
        last = base
        for _ in range(copies):
            words = base.copy()
            for at in rng.integers(0, size, rng.integers(0, 5)):
                words[at] = rng.choice(vocabulary)
            out.append(" ".join(words))
    passage = rng.choice(vocabulary, 60)
    for _ in range(30):
        out.append(" ".join(np.concatenate([rng.choice(vocabulary, 5), passage, rng.choice(vocabulary, rng.integers(5, 12))])))
    out += [" ".join(rng.choice(vocabulary, rng.integers(1, 40))) for _ in range(40)]
    out += ["a b c d e f g", "A B C D E F G", "a b c", "a b c", "x " * 50, "x " * 60]
    return [(int(i), t) for i, t in zip(rng.permutation(len(out)), out)]


@pytest.mark.parametrize("block,short", [(J.BLOCK, J.SHORT_LIST), (4, 3), (3, 0)])
def test_components_equal_all_pairs(spark, docs_of, monkeypatch, block, short):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "SHORT_LIST", short)
    rows = families(block)
    want = brute(rows)
    assert joined(spark, docs_of, rows) == want
    assert 10 < len({r[2] for r in want}) < len(rows)


def test_any_table_of_frequencies_gives_the_same(spark, docs_of, monkeypatch):
    rows = families(9, groups=4)
    want = brute(rows)
    rng = np.random.default_rng(3)
    for levels in (np.zeros(1 << J.SLOT_BITS, np.uint8), rng.integers(0, 24, 1 << J.SLOT_BITS).astype(np.uint8)):
        monkeypatch.setattr(J, "frequencies", lambda docs, levels=levels: J.Frequencies(levels, 0.3))
        assert joined(spark, docs_of, rows) == want


def test_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one"), (6, "é É"), (7, "é é"), (8, "w " * 30_000 + " ".join(map(str, range(3000)))), (9, "W " * 30_000 + " ".join(map(str, range(3000)))),
            (4, "one"), (10, "p q r s t"), (10, "p q r s t"), (10, "u v w x y z"), (3, "u v w x y z"), (None, "one"), (None, None), (-5, "a\xa0b c d e f"), (11, "a b c d e f")]
    assert joined(spark, docs_of, rows) == brute(rows)
    assert joined(spark, docs_of, []) == []
    docs = docs_of(rows).withColumnsRenamed({"lang": "c", "source": "id"}).selectExpr("*", "1 as n", "2 as label", "3 as component_id", "4 as token")
    assert sorted((tuple(r) for r in J.jaccard_components(docs).collect()), key=str) == brute(rows)


def test_prefixes_of_links_share_what_the_shorter_asks_for():
    rng = np.random.default_rng(5)
    levels = rng.integers(0, 20, 1 << J.SLOT_BITS).astype(np.uint8)
    met = 0
    for _ in range(400):
        base = np.unique(rng.integers(0, 2**64, rng.integers(1, 80), dtype=np.uint64))
        x, y = (np.unique(np.concatenate([base[rng.random(len(base)) < 0.95], rng.integers(0, 2**64, rng.integers(0, 4), dtype=np.uint64)])) for _ in "xy")
        if not len(x) or not len(y) or 100 * len(np.intersect1d(x, y)) < 80 * len(np.union1d(x, y)):
            continue
        met += 1
        prefixes, ells = [], []
        for s in (x, y):
            tokens, level = J.ordered(s, levels)
            ells.append(J.matches(level))
            prefixes.append(tokens[: len(s) - J.least_common(len(s)) + ells[-1]])
        assert len(np.intersect1d(*prefixes)) >= min(ells)
    assert met > 50


def test_frequent_elements_lengthen_the_prefix():
    assert J.matches(np.zeros(100, np.uint8)) == 1
    some, all_ = J.matches(np.full(100, 4, np.uint8)), J.matches(np.full(100, 20, np.uint8))
    assert 1 < some <= all_ == J.least_common(100)
    assert 1 < J.matches(np.zeros(500, np.uint8), 0.25) < J.least_common(500)


def test_frequencies_from_counts_by_slot():
    rng = np.random.default_rng(7)
    slots = 1 << J.SLOT_BITS
    once = J.estimated(np.bincount(rng.integers(0, slots, 20 * slots), minlength=slots).astype(float))
    assert once.others < 0.02 and (once.levels > 0).mean() < 1e-4
    # Half of the occurrences belong to n-grams of three documents: 2 others for those, 1 on average.
    counts = np.bincount(rng.integers(0, slots, 10 * slots), minlength=slots) + 3 * np.bincount(rng.integers(0, slots, 10 * slots // 3), minlength=slots)
    counts[5] += 4000
    more = J.estimated(counts.astype(float))
    assert 0.8 < more.others < 1.2 and abs(int(more.levels[5]) - 24) < 2 and more.levels[5] == more.levels.max()
    assert J.estimated(np.zeros(slots)).others == 0


def test_shared_counts():
    rng = np.random.default_rng(6)
    left, right = ([np.unique(rng.integers(0, 9000, rng.integers(0, 3000))).astype(np.uint64) for _ in range(7)] for _ in "lr")
    assert (J.shared_counts(left, right) == [[len(np.intersect1d(x, y)) for y in right] for x in left]).all()
