"""Each stage of the pipeline against plain Python on its own input, and the queries against their SQL."""

import collections
from pathlib import Path

import pytest
from test_learned import brute_components, check_files
from test_native import WORD, brute_targets

import __spark_entry__ as entry
import corpus_pipeline
from check_queries import compare
from lakeops.llm import common, decontaminate, quality_pu, queries

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = common.materialise(stage(spark, docs, SF))
        out[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()], docs, after)
        docs = after
    return out


def test_columns_and_registration(stages):
    columns = stages["quality_classifier"][2].columns
    assert all(stages[name][3].columns == columns for name, _ in corpus_pipeline.STAGES[:-1])
    assert entry.queries()["pipeline"] is corpus_pipeline.run and {"op%d" % n for n in range(1, 11)} <= {q.split("_")[0] for q in entry.queries()}
    assert set(queries.ORACLES) <= set(queries.QUERIES) and "pipeline" not in entry.oracle_sql()


def test_quality_stage(spark, stages):
    before, after, docs, _ = stages["quality_classifier"]
    model = quality_pu.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), common.crc_mod("doc_id", 4) != 2)
    score = model.score(quality_pu.features([d["text"] for d in before]))
    want = {d["doc_id"] for d, s in zip(before, score) if s >= 0.7}
    assert {d["doc_id"] for d in after} == want and 0.7 * len(before) < len(want) < len(before)


def test_dedup_stage(stages):
    before, after, *_ = stages["minhash_near_dedup"]
    assert {d["doc_id"] for d in after} == {row[3] for row in brute_components(before)}


def test_decontamination_stage(spark, stages):
    before, after, *_ = stages["benchmark_decontamination"]
    items = [decontaminate.shingles(decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {d["doc_id"] for d in before for there in [decontaminate.shingles(decontaminate.words_of(d["text"]))] if any(len(s & there) >= 0.75 * len(s) for s in items)}
    gone = {d["doc_id"] for d in before} - {d["doc_id"] for d in after}
    assert dirty and gone == dirty


def test_mix_stage(stages):
    before, after, *_ = stages["source_mix"]
    size = {d["doc_id"]: len(WORD.findall(d["text"] or "")) for d in before}
    sizes, taken = collections.Counter(), collections.Counter()
    for d in before:
        sizes[d["source"]] += size[d["doc_id"]]
    for d in after:
        taken[d["source"]] += size[d["doc_id"]]
    largest = {s: max(size[d["doc_id"]] for d in before if d["source"] == s) for s in sizes}
    assert all(abs(taken[s] - want) <= largest[s] / 2 + 1e-6 for s, want in brute_targets(sizes).items())
    assert max(collections.Counter(d["doc_id"] for d in after).values()) <= 2


def test_token_stage(stages):
    from tokenizers import Tokenizer

    before, _, _, after = stages["token_output"]
    rows = after.collect()
    check_files([{"doc_id": d["doc_id"], "text": d["text"]} for d in before], rows, Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json")))


def test_run_equals_its_stages(spark, stages):
    key = lambda r: (r["doc_id"], r["start"])
    assert sorted((r.asDict() for r in corpus_pipeline.run(spark, SF).collect()), key=key) == sorted(stages["token_output"][1], key=key)


def test_stages_of_empty_tables(spark, docs_of):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, sf, name):
    assert compare(queries.QUERIES[name](spark, sf).toArrow(), duck.sql(queries.ORACLES[name]).to_arrow_table()) == ""


def test_odd_rows_through_all_stages(spark, docs_of):
    """Null and repeated ids, null and very long texts, and clashing columns: no stage fails, and clean documents stay."""
    clean = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id").limit(30).collect()]
    rows = [(i, t, "en", "a") for i, t in enumerate(clean)] + [(None, clean[0], None, None), (3, clean[3], "en", "a"), (3, None, "en", "b"), (77, "", None, "b"), (78, None, None, None), (79, " ".join(clean * 20), "en", "a")]
    docs = docs_of(rows).selectExpr("*", "1 as score", "2 as predicted", "3 as label", "4 as id")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = common.materialise(stage(spark, docs, SF))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns, name
            docs = after
    assert after.count() == docs.count() > 10


def test_stages_on_an_empty_table(spark, docs_of):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_collects_of_the_subpackage_are_the_bounded_ones():
    """Samples, codebooks, slots of a fixed table, and items whose bytes are summed first."""
    allowed = {"toxicity.py": ("toPandas(", 1), "quality_pu.py": ("toPandas(", 1), "language_id.py": ("toPandas(", 1), "vector_codes.py": ("toPandas(", 3), "jaccard_join.py": ("toPandas(", 1), "decontaminate.py": (".collect()", 2)}
    for path in sorted((ROOT / "lakeops" / "llm").glob("*.py")):
        text = path.read_text().replace("gc.collect()", "")
        for bad in ("toPandas(", ".collect()", ".rdd", "localCheckpoint", ".crossJoin("):
            name, most = allowed.get(path.name, ("", 0))
            assert text.count(bad) <= (most if bad == name else 0), (path.name, bad)
