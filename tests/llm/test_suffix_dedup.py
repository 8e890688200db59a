import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from docspark.llm import suffix_dedup as sd
from docspark.llm.common import Rolling


def brute(rows, match):
    """(key, bytes, removed, spans, kept) of every row, from all strings of ``match`` bytes."""
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i: i + match] for r in raws for i in range(len(r) - match + 1))
    out = []
    for (k, _), r in zip(rows, raws):
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - match + 1):
            if seen[r[i: i + match]] > 1:
                gone[i: i + match] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        out.append((k, len(r), int(gone.sum()), spans, kept))
    return sorted(out, key=str)


def corpus(seed, alphabet, words=60):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choices(alphabet, k=rnd.randint(1, 6))) for _ in range(words)]
    text = lambda n: " ".join(rnd.choices(vocab, k=n))
    passage, rows = text(30), [(None, None), (1, ""), (2, "short"), (3, "é" * 80), (4, "ab" * 100)]
    for i in range(60):
        t = text(rnd.randint(1, 60))
        if rnd.random() < 0.4:
            t = t[: len(t) // 2] + passage + t[len(t) // 2:]
        rows.append((10 + i, t))
        if rnd.random() < 0.3:
            w = list(t)
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = "#"
            rows.append((100 + i, "".join(w)))
    rows += [(500, text(50))] * 2 + [(None, text(40))] * 2 + [(600, passage * 4)]
    return rows


@pytest.mark.parametrize("match,gram,how", [
    (30, 8, {}), (30, 30, {}), (20, 1, {}), (25, 6, {"bucket": 2}), (25, 6, {"bucket": 2, "run_rows": 3}), (200, 48, {})])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefghé"])
def test_equals_all_strings(spark, match, gram, how, alphabet):
    rows = corpus(match + len(alphabet), alphabet)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string").repartition(3)
    got = sd.remove_repeats(df, match=match, gram=gram, **how).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str) == brute(rows, match)
    assert all(r.kept_in == "x" and sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 500)
    rnd = random.Random(6)
    a = "".join(rnd.choices("abcdef ", k=5000))
    raw = np.frombuffer((a + a[1000:1400]).encode(), np.uint8)
    whole = {(int(f) + b, int(x) + b) for _, p, o, b in sd._pieces(raw, np.array([0, len(raw)]), 60) for f, x in zip(*sd.anchors(p, o, 60, 16)[1:3])}
    assert sorted(w for f, x in whole for w in range(f, x + 1)) == list(range(len(raw) - 59))


def test_merge_sort_orders_suffixes():
    rnd = random.Random(2)
    data = np.array(rnd.choices(range(3), k=900), np.uint8)
    suffix = np.arange(800)
    rnd.shuffle(suffix)
    group = np.sort(np.array(rnd.choices(range(9), k=800)))
    order = sd.merge_sort(data, Rolling(data), suffix, group, 40)
    want = sorted(range(800), key=lambda i: (group[i], data[suffix[i]: suffix[i] + 40].tobytes()))
    assert order.tolist() == want


def test_collisions_are_resolved_by_bytes(monkeypatch):
    """With a hash that cannot tell texts apart the flags still follow the bytes."""
    monkeypatch.setattr(sd.Rolling, "hashes", lambda self, a, b: np.zeros(len(np.atleast_1d(a)), np.uint64))
    made = [(2, b"abcdefgh"), (2, b"xbcdefgh"), (2, b"abcdefgx")]
    flags, _ = sd.repeated(made, np.zeros(3, np.int64), match=6)
    assert [f.tolist() for f in flags] == [[True, True, True], [False, True, True], [True, True, False]]


def test_empty_table(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, sf_dir):
    import __spark_entry__ as entry

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op1_suffix_dedup"](spark, sf_dir).collect()
    want = [(k, n, m, s, hashlib.sha256(kept).hexdigest()) for k, n, m, s, kept in brute(rows, 200)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
