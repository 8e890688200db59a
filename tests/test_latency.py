"""Statistics against a direct reading of their definitions."""

import math
import random

import pytest

from docspark.operators import latency as L


def percentile(values, p):
    return values[min(max(math.ceil(p * len(values)) - 1, 0), len(values) - 1)]


def report(values):
    v = sorted(values)
    mean = sum(v) // len(v)
    sd = int(math.sqrt(sum((x - mean) ** 2 for x in v) / len(v)))
    return {**{n: percentile(v, p) for n, p in L.LEVELS.items()}, "Mean": mean, "Stddev": sd}


@pytest.mark.parametrize("widths", [(1,), (50, 1), (1 << 40, 1000, 7, 1), L.WIDTHS])
def test_against_definition(spark, widths):
    rng = random.Random(3)
    groups = {
        1: [5],
        2: [3, 3, 3, 3],
        3: list(range(1, 11)),
        4: [rng.randrange(10**4) for _ in range(999)],
        5: [7] * 500 + [rng.randrange(1000) for _ in range(500)],
        6: [rng.randrange(10**rng.randrange(1, 19)) for _ in range(200)],
    }
    df = spark.createDataFrame([(g, x) for g, v in groups.items() for x in v], "g int, ns bigint")
    got = {r["g"]: r.asDict() for r in L.latency_summary(df, ["g"], "ns", widths).collect()}
    for g, values in groups.items():
        want = report(values)
        assert {k: got[g][k] for k in want} == want
        assert got[g]["n"] == len(values)


def test_groups_without_success_report_zeros(spark):
    rows = [(1, 5, None, 0, 5), (1, 7, None, 1, 8), (2, 9, "timed out", 2, 11)]
    df = spark.createDataFrame(rows, "g int, ns bigint, error string, started bigint, ended bigint")
    got = {r["g"]: r for r in L.run_report(df, ["g"], "ns", "error", "started", "ended").collect()}
    assert (got[1]["succeeded"], got[1]["failed"], got[1]["wall_ns"], got[1]["Mean"]) == (2, 0, 8, 6)
    assert (got[2]["succeeded"], got[2]["failed"], got[2]["wall_ns"]) == (0, 1, 9)
    assert [got[2][r] for r in L.ROWS] == [0] * len(L.ROWS)


def test_large_values_do_not_overflow(spark):
    big = 4 * 10**18
    df = spark.createDataFrame([(1, big), (1, big), (1, big)], "g int, ns bigint")
    r = L.latency_summary(df, ["g"], "ns").first()
    assert (r["Mean"], r["Stddev"], r["P99"]) == (big, 0, big)


def test_repeats(spark):
    df = spark.createDataFrame([(1, 0, 10), (1, 1, 30)], "level int, rep int, ns bigint")
    rows = {r["row"]: r for r in L.repeat_summary(df, "level", "rep", "ns").collect()}
    assert (rows["P50"]["mean"], rows["P50"]["stddev"], rows["P50"]["repeats"]) == (20.0, 10.0, 2)


def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([(None, 4), (None, 6), (1, 9)], "g int, ns bigint")
    got = {r["g"]: (r["n"], r["Mean"], r["Max"]) for r in L.latency_summary(df, ["g"], "ns").collect()}
    assert got == {None: (2, 5, 6), 1: (1, 9, 9)}
