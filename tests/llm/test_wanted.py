"""Rows of wanted ids."""

from lakeops.llm.wanted import drop_table, rows_of
from lakeops.session import fresh_path, materialise


def test_rows_of_ids(spark, docs_of):
    docs = docs_of([(i, f"t{i}") for i in range(-50, 500)] + [(7, "again"), (None, "none")])
    ids = spark.createDataFrame([(i,) for i in (-50, -1, 0, 7, 499, 9999)], "doc_id long")
    got = sorted((r.doc_id, r.text) for r in rows_of(docs, ids, "doc_id").collect())
    assert got == [(-50, "t-50"), (-1, "t-1"), (0, "t0"), (7, "again"), (7, "t7"), (499, "t499")]
    assert rows_of(docs, ids.where("false"), "doc_id").collect() == []
    assert rows_of(docs, ids, "doc_id").columns == docs.columns


def test_drop_table(spark):
    path = fresh_path(spark, "dropped")
    assert materialise(spark.range(3), path=path).count() == 3
    drop_table(spark, path)
    drop_table(spark, path)
