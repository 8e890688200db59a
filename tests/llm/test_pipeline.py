import base64
import re

import numpy as np
import public_tokenizers
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline as cp
from test_decontam import plain_distance
from test_ngram_join import shingles

LOW = {c: c + 32 for c in range(65, 91)}


def words(text):
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in text.translate(LOW)).split()


def test_every_stage_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(
        [(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (10**6 + 2, "12 34 --", "en", "s", 8)], docs.schema)).cache()
    rows = {r.doc_id: r.text for r in docs.collect()}

    out = cp.language_id(spark, docs, sf_dir)
    assert out.columns == docs.columns
    want = {k for k, t in rows.items() if t and re.search(r"[^\W\d_]", t)}
    assert {r.doc_id for r in out.collect()} == want
    docs = out.cache()

    out = cp.exact_dedup(spark, docs, sf_dir)
    assert out.columns == docs.columns
    best = {}
    for k in want:
        t = rows[k].translate(LOW)
        best[t] = max(k, best.get(t, k))
    want = set(best.values())
    assert sorted(r.doc_id for r in out.collect()) == sorted(want)
    docs = out.cache()

    out = cp.near_dedup(spark, docs, sf_dir)
    assert out.columns == docs.columns
    keys = sorted(want)
    sets = {k: shingles(rows[k]) for k in keys}
    root = {k: k for k in keys}
    find = lambda k: k if root[k] == k else find(root[k])
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = {k for k in keys if find(k) == k}
    assert {r.doc_id for r in out.collect()} == want
    docs = out.cache()

    out = cp.decontaminate(spark, docs, sf_dir)
    assert out.columns == docs.columns
    items = [words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    dirty = set()
    for k in want:
        w = words(rows[k])
        for p in items:
            if len(set(p) & set(w)) >= len(set(p)) - int(0.2 * len(p)) and plain_distance(p, w) <= int(0.2 * len(p)):
                dirty.add(k)
    assert {r.doc_id for r in out.collect()} == want - dirty and dirty
    docs = out.cache()

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in cp.tokenise(spark, docs, sf_dir).collect():
        assert np.frombuffer(r.token_ids, "<u4").tolist() == enc.encode_ordinary(rows[r.doc_id]) and r.round_trip


def test_run_is_registered(spark, sf_dir):
    out = entry.queries()["pipeline"](spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert 0 < out.count() < n and out.where("NOT round_trip").count() == 0
    assert "pipeline" not in entry.oracle_sql()


def test_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
