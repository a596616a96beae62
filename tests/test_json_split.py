"""A JSON document read by several tasks equals the document read by one."""

import json
import random

import pytest

from lakeops.session import fresh_path
from lakeops.sources.json_split import scan_json_elements

SCHEMA = "id bigint, name string, props struct<k: string, n: array<array<bigint>>>, subs array<struct<features: array<struct<a: bigint>>>>"


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def elements(seed, n):
    rnd = random.Random(seed)
    odd = ["", "}", "{", "]},{[", 'say "hi"', "back\\slash", "\\", '\\"', "é\U0001f600", "tab\there", "\n", '"features":[{', "}" * 9, '"', "a" * 300]
    return [{"id": i, "name": "".join(rnd.choices(odd, k=rnd.randrange(0, 4))), "props": {"k": rnd.choice(odd), "n": [[1, 2], [], [i]]}, "subs": [{"features": [{"a": i}, {"a": 2}]}][: rnd.randrange(0, 2)]} for i in range(n)]


def document(found, indent, extra):
    doc = {"type": "x}]", "bbox": [1, [2, 3]], "crs": {"features": [{"id": -1}], "properties": {"name": "{"}}, "others": [{"id": -2}, {"id": -3}]} if extra else {}
    doc["features"] = found
    doc |= {"more": [{"id": -4}], "after": {"features": [{"id": -5}]}} if extra else {}
    return json.dumps(doc, indent=indent, ensure_ascii=indent is None)


def plain(row):
    return json.dumps(row.asDict(recursive=True), sort_keys=True)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("extra", [False, True])
def test_elements_equal_the_document(spark, small_splits, tmp_path, indent, extra):
    found = elements(indent or 1, 120)
    (tmp_path / "one.json").write_text(document(found, indent, extra) + "\n" * bool(extra))
    (tmp_path / "two.json").write_text(document(found[:3], indent, extra))
    (tmp_path / "none.json").write_text(document([], indent, extra))
    (tmp_path / "absent.json").write_text('{"other": [{"id": 9}], "features": 3}')
    got = scan_json_elements(spark, str(tmp_path), field="features", schema=SCHEMA)
    assert sorted(map(plain, got.collect())) == sorted(json.dumps(e, sort_keys=True) for e in found + found[:3])
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "one.json")).rdd.getNumPartitions() > 3


def test_small_files_and_no_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"features":[{"id":1},{"id":2}]}')
    got = scan_json_elements(spark, str(tmp_path), field="features", schema="id bigint")
    assert sorted(r.id for r in got.collect()) == [1, 2]
    (tmp_path / "b.json").write_text("{}")
    assert scan_json_elements(spark, str(tmp_path / "b.json"), field="features", schema="id bigint").count() == 0
