"""Running values in blocks equal a brute-force pass, also when one group holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from lakeops.operators import ordered as O
from lakeops.operators import windows as W


def rows(n=400, seed=3):
    """A third of all rows in group ``hot``, some null keys and values, negative numbers."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None, "c"])
        out.append((key, rng.randint(0, 50), i, rng.choice([None, rng.randint(-9, 9)])))
    rng.shuffle(out)
    return out


def brute(data, keyed=True, descending=False):
    """Running count, sum, min, max and last per row id."""
    groups = {}
    for r in data:
        groups.setdefault(r[0] if keyed else 0, []).append(r)
    result = {}
    for group in groups.values():
        group.sort(key=lambda r: (-r[1], r[2]) if descending else (r[1], r[2]))
        seen = []
        for i, r in enumerate(group, 1):
            if r[3] is not None:
                seen.append(r[3])
            result[r[2]] = (i, sum(seen) if seen else None, min(seen, default=None), max(seen, default=None), seen[-1] if seen else None)
    return result


@pytest.mark.parametrize("keyed", [True, False])
def test_running_matches_brute_force(spark, many_blocks, keyed):
    data = rows()
    df = spark.createDataFrame(data, "k string, t int, id int, v int").repartition(7)
    kinds = ["count", "sum", "min", "max", "last"]
    out = O.running(df, keys=["k"] if keyed else [], order=["t", "id"], outputs=[O.Running(f"r_{k}", k, "v") for k in kinds])
    got = {r["id"]: tuple(r[f"r_{k}"] for k in kinds) for r in out.collect()}
    assert got == brute(data, keyed)


def test_running_descending(spark, many_blocks):
    data = rows(seed=5)
    df = spark.createDataFrame(data, "k string, t int, id int, v int")
    out = O.running(df, keys=["k"], order=["t", "id"], descending=["t"], outputs=[O.Running("n", "count"), O.Running("s", "sum", "v")])
    want = brute(data, descending=True)
    assert {r["id"]: (r["n"], r["s"]) for r in out.collect()} == {i: w[:2] for i, w in want.items()}
    with pytest.raises(ValueError):
        O.running(df, keys=[], order=["t"], descending=["t"], outputs=[O.Running("l", "last", "v")])


def test_hot_group_is_cut_into_blocks(spark, many_blocks):
    df = spark.createDataFrame(rows(), "k string, t int, id int, v int")
    blocks = O.to_blocks(df, ["k"], ["t", "id"])
    assert blocks.where("k = 'hot'").select(O.BLOCK).distinct().count() > 1
    sizes = [r["count"] for r in blocks.groupBy(O.BLOCK).count().collect()]
    assert max(sizes) < len(rows()) / 2


def test_rank_and_dense_rank(spark, many_blocks):
    data = [("a", x) for x in (5, 5, 3, 9, 9, 9, 1)] + [("b", 4), ("b", 4)]
    df = spark.createDataFrame(data, "k string, v int")
    out = O.ranked(O.ranked(df, keys=["k"], order=["v"], name="r"), keys=["k"], order=["v"], name="d", dense=True)
    assert sorted(map(tuple, out.collect())) == [("a", 1, 1, 1), ("a", 3, 2, 2), ("a", 5, 3, 3), ("a", 5, 3, 3), ("a", 9, 5, 4), ("a", 9, 5, 4), ("a", 9, 5, 4), ("b", 4, 1, 1), ("b", 4, 1, 1)]


def test_surrogate_keys_are_dense_above_the_start(spark, many_blocks):
    df = spark.range(300).select(F.sha2(F.col("id").cast("string"), 256).alias("code"))
    out = W.surrogate_key(df, order=["code"], start=40, name="sk").orderBy("code").collect()
    assert [r["sk"] for r in out] == list(range(41, 341))


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, t int, v int")
    assert O.running(df, keys=["k"], order=["t"], outputs=[O.Running("s", "sum", "v")]).count() == 0
    assert W.fill_forward_global(df, "v", order=["t"]).count() == 0


def test_parent_keys_across_blocks(spark, many_blocks):
    rng = random.Random(11)
    data, want = [], {}
    pos = 0
    for file in ("f1", "f2"):
        head = line = disc = None
        for kind in ["L", "LD"] + rng.choices(["H", "L", "LD", "X", "X"], k=300):
            pos += 1
            attr = str(rng.randint(1, 99))
            if kind == "H":
                head = attr
            elif kind == "L" and head is not None:
                line = f"{head}L{attr}"
            elif kind == "LD" and line is not None:
                disc = f"{line}LD{attr}"
            data.append((file, pos, kind, attr))
            want[pos] = (head, line, disc)
    df = spark.createDataFrame(data, "file string, pos int, kind string, attr string").repartition(5)
    levels = [W.Level("h", "H", ("attr",)), W.Level("l", "L", ("attr",), "h"), W.Level("d", "LD", ("attr",), "l")]
    out = W.propagate_parent_keys(df, record_type="kind", levels=levels, file_col="file", position_col="pos")
    assert {r["pos"]: (r["h"], r["l"], r["d"]) for r in out.collect()} == want


def test_streak_resets_after_a_gap(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-02"), (1, "2024-01-02"), (1, "2024-01-05")], "u int, d string")
    out = W.running_streak(df, keys=["u"], date="d").orderBy("d").collect()
    assert [r["days_in_state"] for r in out] == [1, 2, 1]


def test_one_row_per_parent_at_any_size(spark):
    from lakeops.operators.nested import array_from_rows

    rows = spark.range(25_001).selectExpr("int(id < 25000) as k", "id as v")
    out = {r.k: len(r.vs) for r in array_from_rows(rows, keys=["k"], fields=["v"], name="vs").collect()}
    assert out == {1: 25_000, 0: 1}


def test_running_sums_of_floating_numbers_are_refused(spark):
    import pytest

    from lakeops.operators.ordered import Running, running

    df = spark.range(5).selectExpr("id", "double(id) as v")
    with pytest.raises(ValueError):
        running(df, keys=[], order=["id"], outputs=[Running("s", "sum", "v")])


def test_parent_keys_of_files_read_in_pieces(spark, tmp_path):
    from lakeops.sources import files as R

    rng = random.Random(5)
    want, conf = {}, {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "0", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    for file in range(3):
        head = line = disc = day = None
        lines = []
        for n, kind in enumerate(["L", "LD"] + rng.choices(["H", "L", "LD", "X", "X", "X"], k=150)):
            attr = str(rng.randint(1, 99))
            if kind == "H":
                head, day = attr, f"d{attr}"
            elif kind == "L" and head is not None:
                line = f"{head}L{attr}"
            elif kind == "LD" and line is not None:
                disc = f"{line}LD{attr}"
            lines.append(f"{file}-{n}|{kind}|{attr}|d{attr}")
            want[f"{file}-{n}"] = (head, line, disc, day)
        (tmp_path / f"f{file}.txt").write_text("\n".join(lines) + "\n")
    levels = [W.Level("h", "H", ("attr",)), W.Level("l", "L", ("attr",), "h"), W.Level("d", "LD", ("attr",), "l")]
    kept = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = R.with_position(R.scan_delimited(spark, str(tmp_path), schema=R.text_schema(["id", "kind", "attr", "day"])))
        assert rows.select(R.FILE, R.split_start()).distinct().count() > 6
        out = W.propagate_parent_keys(rows, record_type="kind", levels=levels, file_col=R.FILE, position_col=R.POSITION, carried={"of": ("H", "day")}, block=R.split_start())
        assert "Exchange rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()
        assert {r["id"]: (r["h"], r["l"], r["d"], r["of"]) for r in out.collect()} == want
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
