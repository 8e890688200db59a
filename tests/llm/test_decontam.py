import random

import pyarrow as pa
import pytest

from docspark.llm import decontam as dc
from docspark.llm.common import text_bytes

VOCAB = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 30


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_bit_parallel_distance():
    rnd = random.Random(1)
    for _ in range(300):
        p, t = (rnd.choices("abcd", k=rnd.randint(1, n)) for n in (90, 120))
        d, end = dc.edit_distance(p, t)
        assert d == plain_distance(p, t) == plain_distance(p, t[:end] if end else [])


def edited(rnd, words, k):
    w = list(words)
    for _ in range(k):
        at = rnd.randrange(len(w))
        how = rnd.randrange(3)
        if how == 0:
            w[at] = rnd.choice(VOCAB)
        elif how == 1:
            del w[at]
        else:
            w.insert(at, rnd.choice(VOCAB))
    return w


def brute(texts, items):
    """All (text, item) with a part at a small enough distance, by the plain table of distances."""
    split = lambda t: [x for x in "".join(c if c.isalnum() and c.isascii() or ord(c) > 127 else " " for c in (t or "").lower()).split()]
    out = {}
    for i, t in enumerate(texts):
        for k, item in items:
            p = split(item)
            if p and (d := plain_distance(p, split(t))) <= int(len(p) * 0.2 + 1e-9):
                out[i, k] = d
    return out


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(9)
    items = [(i, " ".join(rnd.choices(VOCAB[:300], k=n))) for i, n in enumerate([1, 2, 3, 5, 6, 7, 8, 10, 14, 20, 40, 80] * 2)]
    items += [(50, ""), (51, None), (52, items[9][1])]
    texts = [None, "", "the of and", " ".join(rnd.choices(VOCAB, k=3000))]
    for k, t in items[:24]:
        w = t.split()
        for share in (0, 0.1, 0.2, 0.4):
            body = edited(rnd, w, int(len(w) * share)) if len(w) > 2 else w
            texts.append(", ".join(rnd.choices(VOCAB, k=20)) + ".\n" + " ".join(body).upper() + "! " + " ".join(rnd.choices(VOCAB, k=15)))
    return texts, items


def test_recall_and_precision_against_brute_force(case):
    texts, items = case
    want = brute(texts, items)
    index = dc.Index(tuple((k, t or "") for k, t in items))
    got = {(r[0], index.ids[r[1]]): r[2] for r in index.matches(*text_bytes(pa.array(texts)))}
    assert set(got) <= set(want)
    assert len(set(got)) >= 0.98 * len(want)
    assert all(got[k] == want[k] for k in got)


def test_frames(spark, case):
    texts, items = case
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(4, texts[4], "x")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = {tuple(r) for r in dc.find(df, bench).collect()}
    assert {tuple(r) for r in dc.find(df, bench, block_bytes=200).collect()} == one
    for doc_id, _, distance, n, start, end in one:
        part = texts[doc_id].encode()[start:end].decode()
        assert 0 <= distance <= 0.2 * n and part
    clean = dc.remove(df, bench)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, *_ in one}
    assert dc.find(df.limit(0), bench).count() == 0 and dc.find(df, bench.limit(0)).count() == 0
    assert dc.remove(df, bench.limit(0)).count() == df.count()


def test_query(spark, sf_dir):
    import __spark_entry__ as entry

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in entry.queries()["op7_cgk_decontamination"](spark, sf_dir).collect()}
    assert {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text} <= got


def test_recall_at_every_length():
    """The largest allowed number of edits, evenly spaced or random; no unedited copies among them."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abcdefghij", k=6))
    low = {}
    for n in range(1, 61):
        items = tuple((i, " ".join(word() for _ in range(n))) for i in range(40))
        index = dc.Index(items)
        for kind in ("even", "random"):
            texts = []
            for _, t in items:
                w, edits = t.split(), n // 5
                if kind == "even":
                    for k in range(edits):
                        w[(2 * k + 1) * n // (2 * edits)] = word()
                else:
                    for _ in range(edits):
                        at = rnd.randrange(len(w))
                        w[at: at + rnd.choice([0, 1, 1])] = rnd.choice([[word()], [word()], []])
                texts.append(" ".join([*(word() for _ in range(30)), *w, *(word() for _ in range(30))]))
            hits = {(t, i) for t, i, *_ in index.matches(*text_bytes(pa.array(texts)))}
            low[n, kind] = sum((i, i) in hits for i in range(40)) / 40
    assert all(r == 1 for (n, _), r in low.items() if n < dc.SHORT)
    assert min(low.values()) >= 0.8
    for kind in ("even", "random"):
        for a in range(dc.SHORT, 60, 5):
            assert sum(low[n, kind] for n in range(a, min(a + 5, 61))) / min(5, 61 - a) >= 0.9
