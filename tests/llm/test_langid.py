import random
import zlib

import pytest

from docspark.llm import langid


def greedy(text_symbols, sample_symbols):
    """Phrases of the greedy longest-match parse, by plain search."""
    sample = "".join(map(chr, sample_symbols))
    count, i = 1, 0
    s = "".join(map(chr, text_symbols))
    cur = ""
    for c in s:
        if cur + c in sample:
            cur += c
        else:
            count += 1
            cur = c if c in sample else ""
    return count


def test_parse_equals_plain_search():
    rnd = random.Random(4)
    make = lambda n, a: "".join(rnd.choices(a, k=n))
    samples = (("x", (make(300, "abc d"), make(100, "abd "))), ("y", (make(300, "bcé z"),)))
    model = langid.Model(samples)
    texts = [make(rnd.randint(0, 200), "abcdéz! ") for _ in range(40)] + ["", "日本語", "abc" * 3000]
    s, ends = model.symbols(texts)
    counts = model.phrases(s, ends)
    starts = [0, *ends[:-1].tolist()]
    for k, (_, pieces) in enumerate(samples):
        seq = []
        for p in pieces:
            seq += [*model.symbols([p])[0].tolist(), langid.END]
        for i, (a, b) in enumerate(zip(starts, ends.tolist())):
            blocks = [s[x: min(x + langid.BLOCK, b)].tolist() for x in range(a, b, langid.BLOCK)]
            assert counts[i][k] == sum(greedy(x, seq) for x in blocks)


ROWS = [("the cat and the dog were in the house with them", "en"), ("der Hund und die Katze waren im Haus mit ihnen", "de"),
        ("le chien et le chat étaient dans la maison avec eux", "fr")]


def test_frame(spark):
    labelled = spark.createDataFrame(ROWS * 3 + [(None, "en"), ("x y z", None), ("1 2", "en")], "text string, lang string")
    samples = langid.sample(labelled)
    assert [k for k, _ in samples] == ["de", "en", "fr"]
    rows = [(1, "the dog and the cat", "q"), (1, "the dog and the cat", "q"), (2, "die Katze und der Hund", "q"), (3, None, "q"),
            (4, "", "q"), (5, "12 34 !", "q"), (6, "le chat et le chien " * 20_000, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = {(r.doc_id, r.lang_pred) for r in langid.identify(df, samples).collect()}
    assert out == {(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "fr")}
    got = langid.identify(df, samples).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.score_in == "q" for r in got)
    assert {r.lang_pred for r in langid.identify(df, ()).collect()} == {"und"}
    assert langid.identify(df.limit(0), samples).count() == 0
    assert langid.sample(labelled.limit(0)) == ()


def test_sample_is_bounded(spark):
    many = spark.range(3000).selectExpr("repeat(concat('word', id, ' '), 400) text", "if(id % 3 = 0, 'a', 'b') lang")
    for _, pieces in langid.sample(many, fragments=5, chars=100):
        assert len(pieces) == 5 and all(len(p) <= 100 for p in pieces)


def test_sample_is_full_among_many_copies(spark):
    rows = spark.range(12_000).selectExpr(
        "if(id < 40, concat('word', id), 'the same words again') text", "if(id % 2 = 0, 'a', 'b') lang")
    got = dict(langid.sample(rows))
    want = {}
    for r in rows.selectExpr("lang", "text", "xxhash64(text) h").distinct().orderBy("h").collect():
        want.setdefault(r.lang, []).append(r.text)
    assert {k: len(v) for k, v in want.items()} == {"a": 21, "b": 21}
    assert {k: list(v) for k, v in got.items()} == want
    assert {k: list(v) for k, v in langid.sample(rows, fragments=7)} == {k: v[:7] for k, v in want.items()}


def test_query_is_accurate_on_held_out_rows(spark, sf_dir):
    import __spark_entry__ as entry

    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    got = entry.queries()["op5_cross_parsing_langid"](spark, sf_dir).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert sum(held) / len(held) > 0.97
