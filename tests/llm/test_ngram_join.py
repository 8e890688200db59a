import random
import re

import numpy as np
import pytest

from docspark.llm import components, ngram_join as nj


def shingles(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i: i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """(key, n, component) per row, from all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (k, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((k, len(sets[i]), min(keys) if keys else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(500)] + ["The", "of", "é"]
    passage = rnd.choices(vocab, k=40)
    out = [(None, "a b c d e f g"), (None, None), (3, ""), (4, " \t"), (5, "one two"), (6, "ONE two"), (7, "one two three"), (7, "one two three")]
    k = 10
    for _ in range(60):
        base = rnd.choices(vocab, k=rnd.randint(3, 120))
        if rnd.random() < 0.5:
            base += passage
        for _ in range(rnd.choice([1, 1, 2, 5])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3, 6])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            out.append((k, " ".join(w)))
            k += 1
    family = rnd.choices(vocab, k=150)
    for _ in range(80):
        w = list(family)
        for _ in range(rnd.choice([1, 2, 3])):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        out.append((k, " ".join(w)))
        k += 1
    out.append((k, "x y z v w " * 3000))
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("block_sets,frequent", [(2048, 1 << 16), (7, 20), (2048, 0)])
def test_equals_all_pairs(spark, rows, block_sets, frequent):
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, tok int").repartition(3)
    got = nj.near_components(df, block_sets=block_sets, frequent_limit=frequent).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_edge_at_the_threshold():
    base = list(range(100, 190))
    make = lambda x: np.sort(np.array(x, np.uint64))
    assert nj.join_sets([make(base[:80]), make(base[:80] + list(range(20)))]) == [(1, 0)] or nj.join_sets(
        [make(base[:80]), make(base[:80] + list(range(20)))]) == [(0, 1)]
    assert nj.join_sets([make(base[:79]), make(base[:79] + list(range(20)))]) == []


def test_trie_equals_all_pairs():
    rnd = random.Random(8)
    for _ in range(60):
        base = rnd.sample(range(400), 40)
        sets = []
        for _ in range(25):
            s = set(base[: rnd.randint(20, 40)]) | set(rnd.sample(range(400), rnd.randint(0, 8)))
            sets.append(np.array(sorted(s), np.uint64))
        sets = [np.array(x, np.uint64) for x in {tuple(s.tolist()) for s in sets}]
        root = list(range(len(sets)))
        find = lambda i: i if root[i] == i else find(root[i])
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
        want = {frozenset(j for j in range(len(sets)) if find(j) == find(i)) for i in range(len(sets))}
        root = list(range(len(sets)))
        for i, j in nj.join_sets(sets):
            root[find(i)] = find(j)
        assert {frozenset(j for j in range(len(sets)) if find(j) == find(i)) for i in range(len(sets))} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (7, 7), (100, 101), (200, 201)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 103: 100, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_empty_table(spark):
    assert nj.near_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, sf_dir):
    import __spark_entry__ as entry

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op10_ngram_trie_join"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def family(seed, copies, length=120):
    """Different near copies of one text in a chain: each edits the one before."""
    rnd = random.Random(seed)
    w, out = [f"v{rnd.randrange(300)}" for _ in range(length)], []
    for k in range(copies):
        w = list(w)
        w[rnd.randrange(length)] = f"x{k}"
        out.append((k, " ".join(w)))
    return out


def test_a_large_group_is_dealt_into_bounded_parts():
    import pyarrow as pa

    sid = np.arange(1, 1001, dtype=np.int64)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(np.int64(7), 1000)), pa.array(sid), pa.array(np.full(1000, 50, np.int32))], ["tok", "sid", "n"])
    parts, seen = {}, []
    for out in nj._groups([batch], 64):
        for part, i in zip(out.column("part").to_pylist(), out.column("sid").to_pylist()):
            parts[part] = parts.get(part, 0) + 1
            seen.append(i)
    assert sorted(seen) == sid.tolist() and len(parts) == 16 and max(parts.values()) <= 64


@pytest.mark.parametrize("spread", [0, 6, 30])
def test_representatives_lose_no_link(spread):
    rnd = np.random.default_rng(spread)
    texts = [t for k in range(3) for _, t in family(k, 60, 40 + 30 * k + spread)]
    sets = list(nj.shingle_sets(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])))
    order = rnd.permutation(len(sets))
    sets, n = [sets[i] for i in order], np.array([len(sets[i]) for i in order])
    bits = [nj.bitmap(s) for s in sets]
    root = list(range(len(sets)))
    find = lambda i: i if root[i] == i else find(root[i])
    reps = []
    for lo in range(0, len(sets), 25):
        ids = np.arange(lo, min(lo + 25, len(sets)))
        here = [bits[i] for i in ids]
        for i, j in nj._spanning(ids, n[ids], n[ids], np.zeros(len(ids), np.int64), here):
            root[find(i)] = find(j)
        reps += [(int(ids[x]), *rest) for x, *rest in nj._clusters(n[ids], here)]
    assert len(reps) < len(sets)
    sid, least, most, radius = map(np.array, zip(*reps))
    for i, j in nj._spanning(sid, least, most, radius, [bits[i] for i in sid]):
        root[find(i)] = find(j)
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                assert find(i) == find(j)


def test_many_near_copies_in_small_blocks(spark):
    rows = family(1, 150) + [(k + 1000, t) for k, t in family(2, 150)]
    got = nj.near_components(spark.createDataFrame(rows, "doc_id long, text string"), block_sets=16).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
