import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from docspark.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def texts():
    rnd = random.Random(1)
    parts = ["the", " cat", "  ", "\n\n\n", "'re", "'", "123", "é", "日本", "!?", "\t", "x" * 90, " " * 50, "<|endoftext|>", "\U0001f600"]
    return [None, "", " ", "a", "   "] + ["".join(rnd.choices(parts, k=rnd.randint(1, 400))) for _ in range(60)]


def test_chunks_are_stitched_exactly(reference):
    e = bpe.tokenizer(PATH, PATTERN)
    for t in filter(None, texts()):
        want = reference(t)
        for chunk, overlap in ((7, 5), (40, 10), (64, 64), (1 << 15, 512)):
            assert np.frombuffer(e.encode(t, chunk, overlap), "<u4").tolist() == want


@pytest.mark.parametrize("spread", [1 << 16, 50])
def test_frames_equal_the_library(spark, reference, spread):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(5, texts()[5], "x"), (5, texts()[5], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    out = bpe.decode(bpe.encode(df, PATH, PATTERN, chunk=40, overlap=20, spread=spread), PATH).collect()
    assert len(out) == len(rows)
    for r in out:
        assert np.frombuffer(r.token_ids, "<u4").tolist() == reference(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.n_tokens * 4 == len(r.token_ids) and r.token_ids_in == "x"
    assert bpe.encode(df.limit(0), PATH, PATTERN).count() == 0
    sure = bpe.encode(df, PATH, PATTERN, chunk=40, overlap=20, spread=spread, verify=True)
    assert sure.where("round_trip").count() == len(rows) and sure.where("NOT round_trip OR round_trip IS NULL").count() == 0


def test_query(spark, sf_dir, reference):
    import __spark_entry__ as entry

    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    for r in entry.queries()["op4_byte_bpe"](spark, sf_dir).collect():
        ids = reference(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
