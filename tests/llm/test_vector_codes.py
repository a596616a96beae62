"""Vector codes against plain loops over integers."""

import hashlib
import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from lakeops.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """Codes, errors and digest by definition: rows of (id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [(i, [math.floor(Fraction(x) * 4096) for x in v], lab) for i, v, lab in kept if len(v) == len(kept[0][1])]
    size = len(kept[0][1]) // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for c in cut:
                held[assign(p, c[p])[1]].append(c[p])
            for k, xs in held.items():
                books[p][k] = [sum(col) // len(xs) for col in zip(*xs)]
    best = [[assign(p, c[p]) for p in range(parts)] for c in cut]
    errors = [min(sum(b[0] for b in bs), 2**63 - 1) for bs in best]
    by_label = defaultdict(int)
    for (_, _, lab), e in zip(kept, errors):
        by_label[lab] += e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted([(i, "".join(f"{b[1]:02x}" for b in bs), e, min(by_label[lab], 2**63 - 1), digest) for (i, _, lab), bs, e in zip(kept, best, errors)], key=str)


def coded(spark, rows, **options):
    return sorted([tuple(r) for r in V.compress(spark.createDataFrame(rows, SCHEMA), **options).collect()], key=str)


def test_tree_finds_the_least_index_among_the_nearest_and_skips_subtrees():
    rng = np.random.default_rng(1)
    for spread, size in ((3, 2), (1000, 8), (2, 1)):
        centres = rng.integers(-40 * spread, 40 * spread, (4, size))
        points = (centres[rng.integers(0, 4, 64)] + rng.integers(-spread, spread + 1, (64, size))).astype(np.int64)
        queries = (centres[rng.integers(0, 4, 500)] + rng.integers(-spread, spread + 1, (500, size))).astype(np.int64)
        away = V.squared(queries, points)
        seen = np.zeros(len(queries), np.int64)
        index, best = V.nearest(V.Gnat(points), queries, seen)
        assert (index == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()
        assert seen.mean() < 0.8 * len(points)


def test_tree_on_exact_ties_and_one_point():
    points = np.array([[2, 0], [0, 2], [-2, 0], [0, -2], [2, 0], [0, 0], [0, 0], [1, 1], [-1, -1]], np.int64)
    grid = np.array([[x, y] for x in range(-4, 5) for y in range(-4, 5)], np.int64)
    index, best = V.nearest(V.Gnat(points), grid)
    away = V.squared(grid, points)
    assert (index == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()
    index, _ = V.nearest(V.Gnat(points[:1]), grid)
    assert (index == 0).all()


def test_integers_are_floors_of_any_size():
    x = np.array([[0.1, -0.1, 1e5, -1e5], [1e18, -1e18, 2.0**70, 1.5]])
    assert V.integers(x).tolist() == [[math.floor(Fraction(v) * 4096) for v in row] for row in x.tolist()]
    assert V.integers(x[:1] / 1e5).dtype == np.int64


def test_codes_equal_plain_loops(spark):
    rng = np.random.default_rng(2)
    rows = [(i, np.round(rng.normal(0, 0.2, 16), 2).tolist(), [None, 1, 2][i % 3]) for i in range(60)]
    rows += [(100, None, 1), (101, [None] + [0.1] * 15, 1), (102, [float("nan")] * 16, 1), (103, [float("inf")] + [0.0] * 15, 2), (104, [0.1] * 8, 2), (105, [], None)]
    rows += [(7, rows[7][1], 1), (7, rows[8][1], 1), (None, rows[9][1], None), (-3, rows[5][1], 2)]
    assert coded(spark, rows) == brute(rows)
    assert coded(spark, rows, parts=4, entries=40, rounds=2) == brute(rows, 4, 40, 2)


def test_fewer_rows_than_entries_large_values_and_empty_tables(spark):
    rows = [(1, [0.5, -0.5], 1), (2, [0.5, -0.5], 1), (3, [3.0, 1e7], None)]
    assert coded(spark, rows, parts=2) == brute(rows, 2)
    rows.append((4, [1e18, -3e17], None))
    rows.append((5, [1.1e18, -3e17], None))
    assert coded(spark, rows, parts=2, entries=3, rounds=2) == brute(rows, 2, 3, 2)
    assert coded(spark, []) == [] and coded(spark, [(1, None, 1), (2, [float("nan")] * 8, 1)]) == []
    assert coded(spark, [(1, [0.1] * 7, 1)]) == []
    with pytest.raises(ValueError):
        V.compress(spark.createDataFrame(rows, SCHEMA), entries=300)


def test_clashing_columns_are_left_alone(spark):
    rows = [(i, [i / 10] * 8, 1) for i in range(20)]
    plain = coded(spark, rows)
    more = spark.createDataFrame([r + ("a", 1.0, 2, 3) for r in rows], SCHEMA + ", code string, x double, _label int, error int")
    assert sorted([tuple(r) for r in V.compress(more).collect()], key=str) == plain
