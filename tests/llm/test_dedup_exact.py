import hashlib
import random

import numpy as np
import pytest

from docspark.llm import dedup_exact as de


@pytest.mark.parametrize("n,top", [(0, 10), (1, 1 << 47), (1000, 1 << 48), (500, 600)])
def test_golomb_round_trip(n, top):
    v = np.unique(np.random.default_rng(n).integers(0, top, n, dtype=np.uint64))
    k, coded = de.golomb_encode(v)
    assert de.golomb_decode(k, len(v), coded).tolist() == v.tolist()
    if n == 1000:
        assert len(coded) < 6 * n  # below the plain 48 bits


ROWS = [(None, "x"), (None, None), (3, ""), (3, ""), (4, "ÄB"), (5, "Äb"), (6, "äb"), (7, "solo"), (8, "Q" * 50_000), (9, "q" * 50_000),
        *[(100 + i, "Hot") for i in range(300)], *[(50, "hOT")] * 3, (399, "HOT")]


def brute(rows):
    low = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
    groups = {}
    for k, t in rows:
        groups.setdefault(low(t), []).append(k)
    out = []
    for t, keys in groups.items():
        keep = max((k for k in keys if k is not None), default=None)
        seen = False
        for k in keys:
            kept = k == keep and not seen
            seen |= kept
            out.append((k, keep, len(keys), kept, hashlib.sha256(t.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("bits", [48, 6])
def test_groups_equal_brute_force(spark, bits):
    rnd = random.Random(2)
    rows = ROWS + [(1000 + i, f"w{rnd.randint(0, 200)}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in de.exact_groups(df, owners=7, bits=bits).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_drop_copies_and_empty(spark):
    rows = [(k, t, i) for i, (k, t) in enumerate(ROWS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, group_size long")
    kept = de.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted(str((r.doc_id, (r.text or "").lower()[:9])) for r in kept.collect()) == sorted(
        str((k, (t or "").lower()[:9])) for (k, t), b in _with_flags() if b)
    assert de.exact_groups(df.limit(0)).count() == 0 and de.drop_copies(df.limit(0)).count() == 0


def _with_flags():
    seen, out = set(), []
    for k, t in ROWS:
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        keys = [a for a, b in ROWS if (b or "").translate({c: c + 32 for c in range(65, 91)}) == low]
        keep = max((a for a in keys if a is not None), default=None)
        out.append(((k, t), k == keep and low not in seen))
        if k == keep:
            seen.add(low)
    return out
