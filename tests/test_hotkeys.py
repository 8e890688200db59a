"""The blocked form for hot keys equals the plain window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from docspark.operators import hotkeys as H

HOT = {"min_rows": 20, "max_keys": 3}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for key, n in [("a", 700), ("b", 300), ("c", 30), ("d", 25), ("e", 5), ("f", 1)]:
        # Sparse and clustered positions, with ties decided by a second column.
        spots = [rng.choice([rng.randrange(50), rng.randrange(10**12)]) for _ in range(n)]
        data += [(key, s, i, rng.randrange(3), rng.choice("xyz")) for i, s in enumerate(spots)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, pos bigint, tie bigint, v int, s string").cache()


def test_hot_keys_are_the_largest(rows):
    hot = H.hot_keys(rows, ["k"], "pos", **HOT)
    assert {r["k"] for r in hot.collect()} == {"a", "b", "c"}
    assert H.hot_keys(rows, ["k"], "pos") is None


def test_running_totals(rows):
    w = Window.partitionBy("k").orderBy("pos", "tie").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select("k", "pos", "tie", F.sum("v").over(w).alias("t"), F.row_number().over(
        Window.partitionBy("k").orderBy("pos", "tie")).cast("bigint").alias("n"))
    totals = {"t": F.col("v"), "n": F.lit(1)}
    for limits in (HOT, {}, {**HOT, "max_blocks": 2}):
        got = H.running_totals(rows, ["k"], "pos", totals, ["tie"], **limits)
        assert got.select("k", "pos", "tie", "t", "n").exceptAll(want).count() == 0
        assert got.count() == want.count()


def test_previous_row(rows):
    w = Window.partitionBy("k").orderBy("pos", "tie")
    want = rows.select("k", "pos", "tie", F.lag("s").over(w).alias("p"))
    for limits in (HOT, {}):
        got = H.previous_row(rows, ["k"], "pos", {"p": "s"}, ["tie"], **limits)
        assert got.select("k", "pos", "tie", "p").exceptAll(want).count() == 0
        assert got.count() == want.count()


def test_hot_windows_are_split(rows):
    got = H.running_totals(rows, ["k"], "pos", {"n": F.lit(1)}, ["tie"], **HOT)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_block" in plan
    plain = H.running_totals(rows, ["k"], "pos", {"n": F.lit(1)}, ["tie"])
    assert "Join" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_paired_order(spark):
    d = spark.createDataFrame([(1, 0), (1, 9), (2, 0), (2, 5)], "a bigint, b bigint")
    o = H.paired_order(d, F.col("a"), F.col("b"), "o")
    assert [r["o"] for r in o.orderBy("a", "b").collect()] == sorted({r["o"] for r in o.collect()})


def test_paired_order_of_large_ids(spark):
    rows = [(d, i) for d in (-3, 0, 5) for i in (-(2**63), -1, 0, 7, 2**63 - 1)]
    o = H.paired_order(spark.createDataFrame(rows, "a bigint, b bigint"), F.col("a"), F.col("b"), "o").orderBy("a", "b").collect()
    values = [r["o"] for r in o]
    assert values == sorted(values)


@pytest.mark.parametrize("limits", [HOT, {**HOT, "max_blocks": 4}])
def test_blocks_have_about_equal_rows(spark, limits):
    """Clustered positions, one outlier, and a key that is NULL."""
    rows = [(None if i % 2 else "a", 0 if i < 2 else 10**15 + i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, pos bigint")
    hot = H.hot_keys(df, ["k"], "pos", **limits)
    blocks = H._blocked(df, ["k"], "pos", hot).groupBy("k", "_block").count().collect()
    parts = min(limits.get("max_blocks", 100_000), 256, 2000 // 20)
    assert max(r["count"] for r in blocks) <= 3 * 4000 / min(parts, 200) + 2
    got = H.numbered(df, ["k"], "pos", "n", **limits)
    assert sorted((str(r["k"]), r["n"]) for r in got.collect()) == sorted((str(k), n) for k in (None, "a") for n in range(1, 2001))
