import zlib

import numpy as np
import pytest

from docspark.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_a_bijection(n):
    assert sorted(sharding.permute(np.arange(n), n, 5)) == list(range(n))


def check(rows, shards, n):
    per = {}
    for r in rows:
        per.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == n
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    if n:
        counts = [len(per.get(s, [])) for s in range(shards)]
        assert max(counts) - min(counts) <= 1


def test_nulls_ties_repeated_rows_and_clashing_names(spark):
    rows = [(None, None, 1)] * 3 + [(i % 5, "t", i % 2) for i in range(500)] + [(7, "same", 0)] * 9000 + [(8, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    out = sharding.shuffle_rows(df, 7).collect()
    check(out, 7, len(rows))
    assert sorted(map(str, ((r.doc_id, r.text, r.shard_in) for r in out))) == sorted(map(str, rows))
    assert {tuple(r) for r in sharding.shuffle_rows(df.repartition(9), 7).collect()} == {tuple(r) for r in out}
    assert sharding.shuffle_rows(df.limit(0), 7).count() == 0


def test_query(spark, sf_dir):
    import __spark_entry__ as entry

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    out = entry.queries()["op6_feistel_sharding"](spark, sf_dir).collect()
    check(out, 24, len(docs))
    want = {(r.doc_id, len(r.text.encode()) + 8, zlib.crc32(r.text.encode())) for r in docs}
    assert {(r.doc_id, r.size, r.text_crc32) for r in out} == want
    assert {(r.law, r.grown_shard) for r in out} == {("rows", None)}
