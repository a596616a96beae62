"""The trained operators and those that run Python in tasks, against plain Python and held-out labels."""

import collections
import io
import itertools
import re
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from lakeops.llm import common, decontaminate, features, language_id, near_dedup, quality_pu, queries, token_files, toxicity

SF = "/root/testdata/sf0.01"
ODD = [None, "", " \n\t ", "a", "one two three four", "Ünïcode ſtraße \U0001f600 ΑΣ", "x " * 30_000, "<|endoftext|> \x85 I'M don't 12,3\r\n\x0bk \x1c", "same text here for the test of ties", "same text here for the test of ties"]


def documents(spark, folder):
    return [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


# --- near duplicates


def brute_sets(rows):
    out = []
    for d in rows:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")]
        out.append(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    return out


def brute_components(rows):
    sets, holders = brute_sets(rows), collections.defaultdict(list)
    for k, s in enumerate(sets):
        if rows[k]["doc_id"] is not None:
            for x in s:
                holders[x].append(k)
    common_ = collections.Counter(p for ks in holders.values() for p in itertools.combinations(ks, 2))
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, b), n in common_.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            parent[find(a)] = find(b)
    least = {}
    for k, d in enumerate(rows):
        if d["doc_id"] is not None:
            least[find(k)] = min(least.get(find(k), d["doc_id"]), d["doc_id"])
    return sorted((d["doc_id"] is None, d["doc_id"] or 0, len(sets[k]), None if d["doc_id"] is None else least[find(k)]) for k, d in enumerate(rows))


def dedup_of(rows):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in rows)


def test_near_duplicates_of_the_tables(spark):
    rows = documents(spark, SF)
    got = queries.QUERIES["op6_near_dedup"](spark, SF).collect()
    assert dedup_of(got) == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def near_copies(rng, base, n, changed):
    out = []
    for _ in range(n):
        words = list(base)
        for k in rng.choice(len(words), changed, replace=False):
            words[k] = f"new{rng.integers(10**9)}"
        out.append(" ".join(words))
    return out


def test_near_duplicates_of_odd_and_planted_rows(spark, docs_of):
    rng = np.random.default_rng(1)
    base = [f"w{k}" for k in range(200)]
    texts = ODD + near_copies(rng, base, 120, 3) + [" ".join(base)] * 40 + near_copies(rng, base, 60, 6)
    chain = [f"c{k}" for k in range(400)]
    texts += [" ".join(chain[k : k + 120]) for k in range(0, 200, 14)]  # each links with the next only
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [passage + " " + " ".join(f"q{i}_{k}" for k in range(100)) for i in range(80)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[20]), (None, None), (5, "quite another text under the same id as before")]
    docs = docs_of(rows).withColumnsRenamed({"lang": "n", "source": "label"})
    want = brute_components([{"doc_id": r[0], "text": r[1]} for r in rows])
    assert dedup_of(near_dedup.near_duplicates(docs).collect()) == want
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.where("doc_id = 3").count() == 1 and kept.where("doc_id is null").count() == 2
    assert near_dedup.near_duplicates(docs_of([])).count() == 0


def test_one_of_each_decides_by_id_and_text(spark, docs_of):
    words = [f"w{k}" for k in range(60)]
    one, near, other, far = " ".join(words), " ".join([*words[:59], "x"]), " ".join(f"v{k}" for k in range(60)), " ".join(f"u{k}" for k in range(30))
    rows = [(1, one), (2, near), (2, other), (3, other), (4, far), (4, far), (5, ""), (5, ""), (6, None), (None, one), (7, near), (7, one), (-8, far)]
    # Of id 2 the near copy of id 1 goes, the other text stays; ids 3, 4 and 7 lose to 2, -8 and 1.
    kept = near_dedup.one_of_each(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, one), (2, other), (5, ""), (6, None), (None, one), (-8, far)], key=str)
    # Two texts of one id that are near copies of each other: one stays.
    assert [r.doc_id for r in near_dedup.one_of_each(docs_of([(9, one), (9, near)])).collect()] == [9]


def test_remaining_pairs_are_found_without_hubs(spark, docs_of, monkeypatch):
    """With no hub pairs and blocks of a few members, the second phase alone finds every link."""
    monkeypatch.setattr(near_dedup, "_hub_pairs", lambda buckets, classes: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 7)
    rng = np.random.default_rng(2)
    rows = [(i, t) for i, t in enumerate(near_copies(rng, [f"w{k}" for k in range(150)], 60, 2) + ["some other text that is long enough to have shingles"])]
    want = brute_components([{"doc_id": i, "text": t} for i, t in rows])
    assert dedup_of(near_dedup.near_duplicates(docs_of(rows)).collect()) == want


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(3)
    for n in (1, 20, 240, 5000):
        base = rng.integers(0, 2**63, n + n // 7, dtype=np.uint64)
        a, b = np.unique(base[:n]), np.unique(base[n // 7 :])
        table = near_dedup.sketches([a, b, np.zeros(0, np.uint64)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert (table[:2] != np.iinfo(np.uint64).max).all() and (table[2] == np.iinfo(np.uint64).max).all()
        assert abs((table[0] == table[1]).mean() - true) < 0.15


def test_components_of_long_paths(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(10, 60)] + [(100, 101)], "a long, b long")
    got = {r.a: r.label for r in near_dedup.components(links).collect()}
    assert got == {k: 10 for k in range(10, 61)} | {100: 100, 101: 100}


# --- token files


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def check_files(rows, got, tokenizer):
    """Rows in order of id, as the query must return them."""
    start, want = 0, collections.Counter()
    for d in sorted(rows, key=lambda d: d["doc_id"]):
        ids = np.array(tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        want[d["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    assert collections.Counter(tuple(r) for r in got) == want


def test_token_files_of_the_tables(spark, tokenizer):
    check_files(documents(spark, SF), queries.QUERIES["op9_token_files"](spark, SF).collect(), tokenizer[1])


def test_token_files_of_odd_rows(spark, docs_of, tokenizer, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD)]
    docs = docs_of(rows).withColumnsRenamed({"lang": "path", "source": "start"})
    manifest = token_files.write_token_files(docs, tokenizer[0], folder=f"file://{tmp_path}/t", file_ids=100)
    assert manifest.count() > 1
    check_files([{"doc_id": i, "text": t} for i, t in rows], token_files.read_documents(manifest).collect(), tokenizer[1])
    twice = docs_of([(4, "b a"), (4, "b a"), (None, "z"), (-1, None)])
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in token_files.read_documents(token_files.write_token_files(twice, tokenizer[0])).collect())
    assert [g[1] for g in got] == [None, -1, 4, 4] and got[0][0] == 0 and all(a[0] + a[2] == b[0] for a, b in zip(got, got[1:]))
    assert token_files.read_documents(token_files.write_token_files(docs_of([]), tokenizer[0])).count() == 0


def test_packing_round_trip():
    rng = np.random.default_rng(4)
    for n in (0, 1, 127, 128, 129, 3000):
        for most in (1, 2, 300, 49408, 2**32 - 1):
            ids = rng.integers(0, most, n, dtype=np.uint64).astype(np.uint32)
            if n > 10:
                ids[rng.integers(0, n, n // 20)] = 2**32 - 1
            opened = token_files.TokenFile(io.BytesIO(token_files.file_bytes([7, None], np.array([n - n // 3, n // 3]), ids)))
            assert (opened.ids() == ids).all() and opened.doc_ids == [7, None] and opened.counts.tolist() == [n - n // 3, n // 3]
            for a, b in ((0, 1), (100, 177), (127, 129), (n - 1, n), (5, 5)):
                assert (opened.ids(max(0, a), b) == ids[max(0, a) : b]).all()
    small = token_files.pack(np.full(12_800, 9, np.uint32))[0]
    assert len(small) == 100 * 6  # equal values need no bits


def test_parts_encode_like_whole_texts(tokenizer):
    encode = token_files.Encoder(tokenizer[0])
    texts = [t or "" for t in ODD] + ["é" * 300, "ſecret İstanbul ΣΑΣ σας <|startoftext|>"]
    assert encode.by_part and [x.tolist() for x in encode(texts)] == encode.whole(texts)
    assert [x.tolist() for x in encode(texts)] == encode.whole(texts)


def test_capitals_and_marks_share_one_encoding(tokenizer):
    encode = token_files.Encoder(tokenizer[0])
    texts = ["Tree tree, TREE!! tree###", "élan. ÉLAN Élan;"]
    assert [x.tolist() for x in encode(texts)] == encode.whole(texts)
    assert set(encode.place) == {"", "tree", ",", "!!", "###", ".", ";", "élan", "Élan"}


def test_random_texts_encode_like_whole_texts(tokenizer, monkeypatch):
    rng = np.random.default_rng(3)
    pieces = ["a", "Ab", "é", "É", "e\u0301", "ñ.", "'s", "'S", "'", "!", "?!", ".", ",", "|", "~^`", "<|startoftext|>", "<|STARTOFTEXT|>", "<|", "7", "x9", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "漢", "ß", "ǅ", "Ѡ", "=\u0338", "İ", "\U0001f600", "###"]
    texts = ["".join(rng.choice(pieces, n)) for n in rng.integers(0, 30, 3000)]
    monkeypatch.setattr(token_files, "CACHED_WORDS", 500)
    monkeypatch.setattr(token_files, "CHUNKS_AT_ONCE", 100)
    encode = token_files.Encoder(tokenizer[0])
    for k in range(0, len(texts), 700):
        assert [x.tolist() for x in encode(texts[k : k + 700])] == encode.whole(texts[k : k + 700])


# --- memory of workers


@pytest.mark.parametrize("module", [language_id, quality_pu])
def test_features_are_held_for_few_texts(spark, docs_of, monkeypatch, module):
    width = features.HASHED + features.STATS
    model = language_id.Model(["aa", "bb"], language_id.codewords(2), np.zeros((features.HASHED + 1, 1), np.float32), np.ones((2, 1), np.float32))
    if module is quality_pu:
        model = quality_pu.Model(np.zeros(width, np.float32), 0.0, np.zeros(width, np.float32), np.ones(width, np.float32), 0.5)
    caught = []

    def catch(fn, kind):
        caught.append(fn)
        return lambda column: common.F.struct(common.F.lit("aa").alias("lang_pred"), common.F.lit(1.0).alias("score"), common.F.lit(False).alias("ambiguous")) if module is language_id else common.F.lit(1.0)

    monkeypatch.setattr(module.F, "pandas_udf", catch)
    getattr(module, "identified" if module is language_id else "scored")(docs_of([(1, "a")]), model)
    texts = pd.Series([f"text number {k}" for k in range(8000)])
    tracemalloc.start()
    [out] = caught[0](iter([texts]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 8000 and peak < 4 * features.TEXTS_AT_ONCE * 4 * width + 4_000_000
    assert [len(x) for x in caught[0](iter([texts[:0]]))] == [0]


def test_trigrams_of_a_long_text_are_counted_in_pieces(monkeypatch):
    raw = np.random.default_rng(1).integers(0, 256, 1000, dtype=np.uint8).tobytes()
    want = features.gram_counts(raw)
    for n in (1, 2, 7, 998, 999):
        monkeypatch.setattr(features, "BYTES_AT_ONCE", n)
        assert (features.gram_counts(raw) == want).all() and features.gram_counts(b"ab").sum() == 0


def test_workers_get_long_texts_a_few_at_a_time(spark):
    from lakeops.session import tune

    tune(spark)
    rows = spark.range(3000, numPartitions=1).selectExpr("repeat('x', 10000) as text")
    sizes = rows.mapInArrow(lambda batches: (pa.record_batch([pa.array([b.nbytes])], ["n"]) for b in batches), "n long").collect()
    assert len(sizes) > 5 and max(r.n for r in sizes) < 6_000_000


# --- benchmark decontamination


def test_leaks_of_the_tables(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = documents(spark, SF)
    own = {i: decontaminate.shingles(decontaminate.words_of(t)) for i, t in items}
    want = {(d["doc_id"], i) for d in rows for there in [decontaminate.shingles(decontaminate.words_of(d["text"]))] for i, s in own.items() if len(s & there) >= 0.75 * len(s)}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op2_decontamination"](spark, SF).collect()}
    assert want <= got and len(want) > 10
    # Anything more must rest on the question and the answer.
    assert all(r.question_overlap >= 0.75 and r.answer_overlap >= 0.75 for r in queries.QUERIES["op2_decontamination"](spark, SF).collect() if (r.doc_id, r.item_id) not in want)


def test_search_returns_every_piece_above_the_threshold():
    rng = np.random.default_rng(5)
    vocabulary = [f"t{k}".encode() for k in range(60)]
    items = []
    for k in range(90):
        item = decontaminate.Item(k, "x")
        item.words = [vocabulary[i] for i in (rng.random(rng.integers(3, 90)) ** 2 * 60).astype(int)]
        items.append(item)
    index = decontaminate.Index(items)
    for _ in range(60):
        some = sorted({int(x) for x in rng.integers(0, len(index.terms), 25)})
        dense = collections.Counter()
        for t in some:
            for group in index.postings:
                for p, w in zip(*group.get(t, ([], []))[:2]):
                    dense[p] += w
        for threshold in (0.1, 0.3, 0.55):
            got = {p: round(w, 5) for g in range(decontaminate.GROUPS) for p, w in index.search(some, g, threshold)}
            assert got == {p: round(w, 5) for p, w in dense.items() if w >= threshold - 1e-6}


def test_leaks_of_odd_rows(spark, docs_of):
    long_item = " ".join(f"l{k}" for k in range(300))
    items = spark.createDataFrame([(1, "What is the name of the tall tower by the river? It is the tower of Belem."), (2, None), (3, "tiny item"), (4, long_item), (4, long_item)], "item_id long, text string")
    text = "intro words " * 40 + "what is the name of the tall tower by the river?? it is the TOWER of Belem. " + "more words " * 60
    docs = docs_of([(1, text), (2, "what is the name of the tall mountain by the lake? it is the tower of London."), (3, "pad " * 70 + long_item + " pad" * 70), (4, None), (5, ""), (6, "a tiny item here"), (None, text), (1, text)])
    docs = docs.withColumnsRenamed({"lang": "item_id", "source": "score"})
    got = collections.Counter((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect())
    assert got == {(1, 1): 2, (None, 1): 1, (3, 4): 2, (6, 3): 1}
    left = decontaminate.clean_rows(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 4, 5]
    assert decontaminate.leaks(docs_of([]), items).count() == 0 and decontaminate.leaks(docs, items.limit(0)).count() == 0
    split = spark.createDataFrame([(9, "what is the name of the tall tower", "belem")], "item_id long, question string, answer string")
    assert {r.doc_id for r in decontaminate.leaks(docs, split).collect()} == {1, None}


def test_every_place_of_an_item_is_verified():
    question, answer = [f"q{k}" for k in range(30)], [f"a{k}" for k in range(10)]
    edited = ["x" if k in (10, 20) else w for k, w in enumerate(question)] + answer
    mixed = question[:28] + ["y", "z"] + answer[::-1]
    index = decontaminate.Index([decontaminate.Item(1, " ".join(question + answer), " ".join(question), " ".join(answer))])
    pad = [f"p{k}" for k in range(300)]
    found = lambda *parts: index.matches([w.encode() for part in parts for w in part])
    (alone,) = found(pad, mixed, pad)
    assert not found(pad, edited, pad)
    for text in ((pad, edited, pad, mixed, pad), (pad, mixed, pad, edited, pad)):
        (both,) = found(*text)
        assert both[0] == 1 and both[2:5] == alone[2:5] and min(both[3:5]) >= decontaminate.OVERLAP > both[2]


def test_bounds_of_a_long_text_come_in_parts(monkeypatch):
    rng = np.random.default_rng(12)
    index = decontaminate.Index.__new__(decontaminate.Index)
    index.terms, index.most = {}, rng.random((50, decontaminate.GROUPS)).astype(np.float32) / 40
    index.terms = {b"t%d" % k: k for k in range(49)}
    for n in (1, 31, 32, 33, 64, 65, 96, 97, 1000, 3210):
        ids = rng.integers(0, 50, n)
        whole = {(int(p), int(g)) for p, g in zip(*np.nonzero(index.bounds(ids) >= decontaminate.THRESHOLD - 1e-5))}
        for at_once in (1, 2, 7, 10_000):
            monkeypatch.setattr(decontaminate, "PASSAGES_AT_ONCE", at_once)
            assert set(index.hopeful(ids)) == whole, (n, at_once)
    assert whole


def test_index_in_parts_finds_the_same(spark, docs_of, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    whole = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 3000)
    assert len(decontaminate._parts(items.select("item_id", "text"), "item_id")) > 2
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()} == whole


def test_index_in_parts_scores_the_same(spark, docs_of, monkeypatch):
    rng = np.random.default_rng(9)
    texts = [" ".join(f"t{int(x)}" for x in rng.random(n) ** 2 * 90) for n in rng.integers(20, 70, 60)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    # Copies without their last words, so that scores rest on the weights.
    docs = docs_of([(k, " ".join(t.split()[:-3])) for k, t in enumerate(texts)])
    scores = lambda: {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(docs, items).collect()}
    whole = scores()
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 2000)
    assert 2 < len(decontaminate._parts(items, "item_id")) < 20
    assert len(whole) >= 60 and min(whole.values()) < 0.99 and scores() == pytest.approx(whole, abs=1e-6)


# --- trained operators


def auc(score, label):
    a, b = score[label == 1], score[label == 0]
    return (a[:, None] > b[None]).mean() + (a[:, None] == b[None]).mean() / 2


def held_out(spark, name, label, folder="/root/testdata/sf0.1"):
    rows = queries.QUERIES[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    rows = rows[rows["held_out"] & rows[label].notna()]
    return rows["score"].to_numpy(), rows[label].to_numpy(), rows["predicted"].to_numpy()


def test_quality_on_held_out_labels(spark):
    score, label, predicted = held_out(spark, "op4_quality_classifier", "quality")
    assert auc(score, label) > 0.95 and predicted[label == 1].mean() > 0.97 and predicted[label == 0].mean() < 0.2


def test_toxicity_on_held_out_labels(spark):
    score, label, predicted = held_out(spark, "op3_toxicity", "toxic")
    assert auc(score, label) > 0.9 and predicted[label == 1].mean() > 0.7 and predicted[label == 0].mean() < 0.05


def test_language_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op8_language_id"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (rows["lang"] == rows["lang_pred"]).mean() > 0.99 and rows["score"].between(0, 1).all()


def test_trained_operators_on_odd_rows(spark, docs_of):
    rows = [(i, t, "en" if i % 2 else None, "s") for i, t in enumerate(ODD)] + [(None, "who is", "fr"), (3, "a", "fr")]
    docs = docs_of(rows).withColumnsRenamed({"source": "score", "n_chars": "predicted"})
    labels = spark.createDataFrame([(i, i % 2, i % 3 % 2) for i in range(8)] + [(3, 1, 0), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    everything = common.F.lit(True)
    for scored, train in ((quality_pu.scored, quality_pu.train), (toxicity.scored, toxicity.train)):
        for given in (labels, labels.limit(0)):
            model = train(docs, given, everything)
            got = scored(docs, model).collect()
            assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
            assert scored(docs_of([]), model).count() == 0
        same = {r.score for r in got if r.text == ODD[8]}
        assert len(same) == 1
    for given in (docs, docs.where("lang is null"), docs.where("lang = 'en'")):
        found = language_id.identified(docs, language_id.train(given, everything)).collect()
        assert len(found) == len(rows) and all((r.lang_pred == "und") == (r.score == 0) for r in found)
        assert all(r.lang_pred == "und" for r in found if not any(map(str.isalpha, r.text or "")))


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 12):
        code = language_id.codewords(n)
        apart = [(a != b).sum() for a, b in itertools.combinations(code, 2)]
        assert min(apart) >= code.shape[1] // 3 and (abs(code.sum(axis=0)) < n).all()


def test_prior_is_estimated():
    rng = np.random.default_rng(6)
    p, u = rng.normal(2, 1, 4000), np.concatenate([rng.normal(2, 1, 5600), rng.normal(-2, 1, 2400)])
    assert abs(quality_pu.estimated_prior(p, u) - 0.7) < 0.06


def test_network_gradients():
    rng, words, net = np.random.default_rng(0), toxicity.Words(), toxicity.Network.new()
    words.add([f"w{i}".encode() for i in range(30)])
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    ids = rng.integers(1, 31, (3, toxicity.WINDOW))
    ids[2, 20:] = 0
    label = np.array([1.0, 0, 1.0])
    texts = toxicity.Texts([row[row > 0].astype(np.int32) for row in ids])
    loss = lambda: (np.logaddexp(0, z := net.windows(net.table(words), texts)[0]) - label * z).mean()
    g = net.gradients(words, ids, label, np.ones(3) / 3)
    for k, slope in g.items():
        flat, at = net.w[k].reshape(-1), int(np.abs(slope.reshape(-1)).argmax())
        was = flat[at]
        flat[at] = was + 1e-2
        up = loss()
        flat[at] = was - 1e-2
        down = loss()
        flat[at] = was
        assert slope.reshape(-1)[at] == pytest.approx((up - down) / 2e-2, rel=0.02, abs=1e-6)


def test_every_window_is_there():
    sizes = [0, 1, 39, 40, 41, 0, 71, 400]
    texts = toxicity.Texts([np.arange(1, n + 1, dtype=np.int32) for n in sizes])
    sums, start, count = toxicity.of_windows(texts, texts.flat[:-1].astype(float))
    assert count.tolist() == [0, 1, 1, 1, 2, 0, 32, 361]
    want = [sum(range(i + 1, min(n, i + 40) + 1)) for n in sizes if n for i in range(max(1, n - 39))]
    assert sums.tolist() == want
    owner = np.repeat(np.arange(len(sizes)), count)
    windows = texts.windows(owner, start)
    assert windows.sum(axis=1).tolist() == want and (windows[0, 1:] == 0).all()


def test_every_character_of_long_words_is_read():
    rng = np.random.default_rng(4)
    for n in (1, 11, 12, 13, 20, 21, 22, 45, 20_000):
        word = bytes(rng.integers(97, 123, n).tolist())
        chars = b"^" + word + b"$"
        want = {zlib.crc32(chars[i : i + k], 1) % toxicity.GRAM_ROWS for k in (3, 5, 7) for i in range(max(k == 3, len(chars) - k + 1))}
        read = toxicity.words_of(word.decode())
        words = toxicity.Words()
        words.add(read)
        assert {g for p in read for g in toxicity.gram_rows(p)} == want
        assert set(words.grams[1:].reshape(-1).tolist()) - {toxicity.GRAM_ROWS} == want


def test_a_toxic_part_of_a_long_run_counts():
    rng = np.random.default_rng(8)
    plain, bad = (["".join(map(chr, rng.integers(a, b, 7))) for _ in range(40)] for a, b in ((97, 110), (110, 123)))
    clean = lambda n: [plain[i] for i in rng.integers(0, 40, n)]
    toxic = lambda: [bad[i] for i in rng.integers(0, 40, 12)]
    texts = [" ".join(clean(60)) for _ in range(150)] + [" ".join(clean(30) + toxic() + clean(30)) for _ in range(150)]
    score = toxicity.Scorer(toxicity.fit(texts, np.repeat([0, 1], 150)))
    for gap in ("", ".", "-", "_", "\u00a0"):
        low, high = score([gap.join(clean(2500)), gap.join(clean(1200) + toxic() + clean(1300))])
        assert low < 0.5 < high


def test_samples_are_bounded_and_stable(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "id % 2 as side")
    got = features.sampled(rows, 300)
    assert 200 < got.count() < 400 and sorted(got.collect()) == sorted(features.sampled(rows.repartition(5), 300).collect())
    assert features.sampled(rows, 10_000).count() == 5000 and features.sampled(rows.limit(0), 5).count() == 0
    assert all(100 < r["count"] < 320 for r in features.sampled(rows, 200, by="side").groupBy("side").count().collect())
