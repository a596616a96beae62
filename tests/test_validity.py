"""Look-ups of many versions and distinct counts over periods, against plain Python."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeops.operators import aggs as A
from lakeops.operators import joins as J

FACTS, VERSIONS = "k string, day date, n int", "k string, f date, t date, v int"
DAY = dt.date(2020, 1, 1)


def days(n):
    return DAY + dt.timedelta(days=n)


def sample():
    rnd = random.Random(4)
    facts = [(rnd.choice(["a", "b", "c", None]), rnd.choice([None, *(days(rnd.randrange(0, 400)) for _ in range(9))]), i) for i in range(300)]
    versions = [("a", days(i), days(i + 1), i) for i in range(-30, 390)] + [("b", days(5), days(100), 1000), ("b", days(100), dt.date(9999, 12, 31), 1001), ("b", dt.date(1900, 1, 1), days(5), 1002),
                ("b", days(50), days(60), 1003), ("c", None, days(9), 1), ("c", days(1), None, 2), ("c", days(900), days(950), 3), ("c", days(30), days(20), 4), (None, days(0), days(500), 5), ("d", days(0), days(500), 6)]
    return facts, versions


def row(x):
    return tuple(-10**9 if v is None else v for v in x)


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_bucketed_rows_equal_all_comparisons(spark, closed, how):
    facts, versions = sample()
    fact, dim = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    got = J.join_validity_bucketed(fact, dim, on=["k"], date="day", start="f", end="t", closed=closed, how=how)
    assert got.columns == ["k", "day", "n", "f", "t", "v"]
    want = []
    for k, d, n in facts:
        met = [v for kk, f, t, v in versions if k is not None and kk == k and None not in (d, f, t) and (f <= d <= t if closed else f <= d < t)]
        want += [(n, v) for v in (met or ([None] if how == "left" else []))]
    assert sorted(row((r.n, r.v)) for r in got.collect()) == sorted(map(row, want))


def test_empty_sides_and_other_kinds(spark):
    facts, versions = sample()
    fact, dim = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    args = {"on": ["k"], "date": "day", "start": "f", "end": "t"}
    assert J.join_validity_bucketed(fact.limit(0), dim, **args).count() == 0
    assert J.join_validity_bucketed(fact, dim.limit(0), **args, how="left").count() == len(facts)
    one = J.join_validity_bucketed(fact.where("day = date'2020-01-20'").limit(1), dim, **args, how="left")
    assert one.count() == 1 or one.count() == 0
    with pytest.raises(ValueError):
        J.join_validity_bucketed(fact, dim, **args, how="full")


def test_one_key_with_many_versions_stays_near_its_result(spark):
    n, m = 100_000, 300_000
    start = F.timestamp_seconds(F.col("id") * 600)
    dim = spark.range(n).select(F.lit("a").alias("k"), start.alias("f"), F.timestamp_seconds((F.col("id") + 1) * 600).alias("t"), F.col("id").alias("v"))
    fact = spark.range(m).select(F.lit("a").alias("k"), F.timestamp_seconds((F.col("id") * 7919) % (n * 600)).alias("day"), F.col("id").alias("i"))
    got = J.join_validity_bucketed(fact, dim, on=["k"], date="day", start="f", end="t")
    bad = got.where(F.col("v") != F.floor(((F.col("i") * 7919) % (n * 600)) / 600)).count()
    assert got.count() == m and bad == 0


def test_distinct_counts_over_periods(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("xy"), rnd.randrange(1, 9), rnd.choice([None, rnd.randrange(-5, 40), 32768 * rnd.randrange(0, 3), 10**12 + rnd.randrange(3)]), rnd.randrange(1, 6)) for _ in range(500)]
    rows += [("z", 2, None, None)]
    df = spark.createDataFrame(rows, "g string, w int, e long, o int").withColumns({"e": F.when(F.col("e") >= 0, F.col("e") + 1)})
    periods = [("one", 1, 1), ("four", 1, 4), ("late", 3, 8), ("none", 90, 99)]
    got = {(r.time_period, r.g): (r.a, r.b) for r in A.agg_rolling_distinct(df, periods, rank="w", keys=["g"], entities={"a": "e", "b": "o"}).collect()}
    want = defaultdict(lambda: (set(), set()))
    for g, w, e, o in rows:
        for name, lo, hi in periods:
            if lo <= w <= hi:
                a, b = want[name, g]
                a |= {e} if e is not None and e >= 0 else set()
                b |= {o} if o is not None else set()
    assert got == {k: (len(a), len(b)) for k, (a, b) in want.items()}
