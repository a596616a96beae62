"""The source audit against plain Python, and its blocks."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lakeops.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
TEXTS = [
    None, "", " \t\n\x0b\x0c\r ", "Foo-foo foo, FOO", "the Cat sat on the mat", "Été été STRASSE straße", "12 34 --- ...", "a1b2c3 a\x00b", "the the the the",
    "café café \U0001f600x", "one two three one two", "x" * 70_000 + " " + "word " * 40_000, "K K k İ i",
]


def brute(rows, least, top=50):
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(LOWER)))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for la, _, c in docs if la == lang for t in c)
        kept = sorted(t for t, n in df.items() if n >= least)
        counts = defaultdict(Counter)
        for la, source, c in docs:
            if la == lang:
                counts[source].update({t: c[t] for t in kept if c[t]})

        def share(c):
            total = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        q = share(sum(counts.values(), Counter()))
        p = {s: share(c) for s, c in counts.items()}
        p |= {s: share(Counter()) for la, s, _ in docs if la == lang and s not in p}
        for s in p:
            others = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in p if o != s))
            marks = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])
            for part, found in (("pair", others), ("term", marks[:top])):
                out += [(lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


def audited(spark, docs_of, rows, least, parts=3, **options):
    docs = docs_of([(i, *r) for i, r in enumerate(rows)]).repartition(parts)
    return sorted(tuple(r) for r in D.audit(docs, least_docs=least, **options).collect())


@pytest.mark.parametrize("bits", [D.PARTITION_BITS, 0])
def test_audit_equals_plain_python(spark, docs_of, bits, monkeypatch):
    monkeypatch.setattr(D, "PARTITION_BITS", bits)
    rng = np.random.default_rng(4)
    words = ["alpha", "Beta,", "(beta)", "gamma-delta", "delta", "über", "7up", "eps", "zeta."]
    rows = [(t, lang, source) for k, t in enumerate(TEXTS) for lang, source in ((None, "s1"), ("en", None), ("en", f"s{k % 3}"), ("", "s1"))]
    rows += [(" ".join(rng.choice(words, rng.integers(1, 30))), ["en", "de", None][k % 3], f"s{k % 4}") for k in range(120)]
    rows += [("", "xx", "a"), (None, "xx", "b"), ("rare", "xx", "c")]
    assert audited(spark, docs_of, rows, 4) == brute(rows, 4)
    assert audited(spark, docs_of, rows, 1, top=2) == brute(rows, 1, 2)


def test_documents_at_the_limit_and_chunks_that_overlap(spark, docs_of):
    # "Tie," and "tie" in one document are one document of the term; the parts of a chunk count each time.
    rows = [("Tie, tie tie-tie", "en", "a")] * 29 + [("TIE", "en", "b")]
    assert audited(spark, docs_of, rows, 30) == brute(rows, 30) != []
    assert all(r[4] == 0 for r in audited(spark, docs_of, rows[1:], 30))


def test_empty_tables_repeated_ids_and_clashing_columns(spark, docs_of):
    assert audited(spark, docs_of, [], 1) == []
    rows = [("a b", "en", "x"), ("a b", "en", "x"), ("b c", "en", "y")]
    docs = docs_of([(1, *r) for r in rows]).selectExpr("*", "1 as group_id", "2 as lang_id", "3 as chunk", "4 as value", "5 as block")
    assert sorted(tuple(r) for r in D.audit(docs, least_docs=1).collect()) == brute(rows, 1)


def test_rows_of_a_block():
    chunks, words = [b"a", b"b"], [np.array([0, 1, 0]), np.array([1]), np.array([], np.int32), np.array([0])]
    rows = [r for batch in D.block_rows(7, np.array([1, 0, 1, 1]), np.array([5, 2, 3, 3]), chunks, words) for r in batch.to_pylist()]
    # Documents in order of language and group: 1, 2, 3, 0.
    found = {}
    for r in rows:
        docs, groups, counts, n_docs, _ = D.unpacked(pa.array([r["held"]], pa.binary()))
        assert r["n_docs"] == n_docs[0] and r["place"] & ((1 << D.LANG_SHIFT) - 1) == 7
        found[r["place"] >> D.LANG_SHIFT, r["chunk"]] = (docs.tolist(), groups.tolist(), counts.tolist())
    assert found == {(1, "a"): ([2, 3], [3, 5], [1, 2]), (1, "b"): ([3], [5], [1]), (0, "b"): ([0], [2], [1])}


def test_rows_of_a_block_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    chunks, words = [b"w%d" % k for k in range(50)], [rng.integers(0, 50, rng.integers(0, 60)).astype(np.int32) for _ in range(30)]
    langs, groups = np.sort(rng.integers(0, 2, 30)), np.arange(30) // 5

    def rows():
        return sorted(tuple(r.values()) for batch in D.block_rows(1, langs, groups, chunks, list(words)) for r in batch.to_pylist())

    whole = rows()
    monkeypatch.setattr(D, "CHUNKS_AT_ONCE", 7)
    assert rows() == whole and len({r[1] for r in whole}) == 50


def test_packing_of_many_rows():
    rng = np.random.default_rng(8)
    n_docs, n_groups = rng.integers(1, 9, 200), rng.integers(1, 5, 200)

    def increasing(lengths, most):
        return np.concatenate([np.sort(rng.choice(most, k, replace=False)) for k in lengths])

    docs, groups, counts = increasing(n_docs, 65536), increasing(n_groups, 2**31), rng.integers(1, 2**40, n_groups.sum())
    held = D.packed(docs, n_docs, groups, counts, n_groups)
    for part, rows in ((held, slice(None)), (held.slice(50, 100), slice(50, 150))):
        found = D.unpacked(part)
        assert (found[3] == n_docs[rows]).all() and (found[4] == n_groups[rows]).all()
        first = [0 if rows.start is None else a[: rows.start].sum() for a in (n_docs, n_groups)]
        size = [a[rows].sum() for a in (n_docs, n_groups)]
        for got, want, k in zip(found, (docs, groups, counts), (0, 1, 1)):
            assert (got == want[first[k] : first[k] + size[k]]).all()


def test_rows_of_a_term_that_span_batches():
    def batch(rows):
        lang, term, block, docs = zip(*rows)
        n = np.array([len(d) for d in docs])
        held = D.packed(np.concatenate(docs), n, np.full(len(rows), 4), n, np.ones(len(rows), np.int64))
        return pa.RecordBatch.from_arrays([pa.array([(la << D.LANG_SHIFT) + b for la, b in zip(lang, block)]), pa.array(term), held], ["place", "term", "held"])

    rows = [(1, "a", 1, [0, 1]), (1, "a", 1, [1, 2]), (1, "a", 2, [1]), (1, "b", 2, [5]), (1, "b", 2, [5]), (2, "b", 2, [5, 6])]
    for cuts in ([], [1], [1, 2], [2, 4], [1, 2, 3, 4, 5]):
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        total = Counter()
        for out in D._merged(batch(p) for p in parts):
            for r in out.to_pylist():
                total[r["lang_id"], r["term"], r["group_id"]] += r["n"]
        assert total == {(1, "a", -1): 4, (1, "a", 4): 5, (1, "b", -1): 1, (1, "b", 4): 2, (2, "b", -1): 2, (2, "b", 4): 2}
