import math
import random
import zlib

import pytest

from docspark.llm import toxicity


def describe(text, lexicon):
    return toxicity.describe([text], lexicon)[0]


def col(name, vector):
    return vector[toxicity.FEATURES.index(name)]


def test_features_by_hand():
    lexicon = {"fool": 2.0, "dunce*": 1.0, "sadl*": 9.0}  # beginnings have five or seven letters
    v = describe("You fool! A DUNCER, sadly; f00l and f.o.o.l?!! nooo", lexicon)
    n = 13  # you fool a duncer sadly f l and f o o l nooo
    assert col("log_words", v) == pytest.approx(math.log1p(n))
    assert col("hit_density", v) == pytest.approx(2 / n)
    assert col("weight_density", v) == pytest.approx(3 / n)
    assert col("top_weight", v) == 2.0
    assert col("stem_density", v) == pytest.approx(1 / n)
    assert col("log_kinds", v) == pytest.approx(math.log1p(2))
    assert col("you_density", v) == pytest.approx(1 / n)
    assert col("near_share", v) == 1.0
    assert col("hidden_density", v) == pytest.approx(2 / n)  # f00l and f.o.o.l
    assert col("obfuscated_words", v) == pytest.approx(2 / n)
    assert col("drawn_runs", v) == pytest.approx(1 / n)
    assert col("shouts", v) == pytest.approx(1 / n)
    assert col("capital_share", v) == pytest.approx(8 / 32)
    assert col("shouted_words", v) == pytest.approx(1 / n)


def test_spelled_out_words_and_order_of_texts():
    lexicon = {"fool": 2.0}
    texts = ["a f o o l b", "f o o l now", "you", "far from a fool", "x y z", ""]
    many = toxicity.describe(texts, lexicon)
    for text, row in zip(texts, many):
        assert row.tolist() == describe(text, lexicon).tolist()
    assert [col("spaced_runs", r) > 0 for r in many] == [True, True, False, False, False, False]
    assert [col("hidden_density", r) > 0 for r in many] == [False, True, False, False, False, False]
    assert not any(col("near_share", r) for r in many)  # the pronoun is another text's


def test_distance_and_texts_without_words():
    far = "you " + "calm " * 6 + "fool " + "calm " * 6 + "you"
    v = describe(far, {"fool": 1.0})
    assert col("near_share", v) == 0.0 and col("you_density", v) > 0
    assert describe(None, {}).tolist() == describe("", {}).tolist() == [0.0] * len(toxicity.FEATURES)
    assert all(math.isfinite(x) for t in ("!!!", "1 2", "\n", "😀", "a") for x in describe(t, {"a": 1.0}))


def corpus(n, seed=1):
    rnd = random.Random(seed)
    calm = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(10)]
    bad = ["fool", "dunce", "nitwit"]
    rows, labels = [], []
    for i in range(n):
        words = rnd.choices(calm, k=rnd.randint(5, 60))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad) + rnd.choice(["", "", "!!", "###"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = corpus(600)
    docs = spark.createDataFrame([*rows, (None, "no key"), (9_000, None), (9_001, "")], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (0, None), (1, None), (None, 1), (70_000, 1), (9_000, 0)], "doc_id long, toxic int")
    return toxicity.fit(docs, marks, trees=8), docs


def test_unseen_texts(spark, learned):
    model, _ = learned
    rows, labels = corpus(300, seed=2)
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    truth = dict(labels)
    assert sum(r.predicted == truth[i] for i, r in got.items()) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_defined_cases(spark, learned):
    model, _ = learned
    rows = [(1, None, "a"), (2, "", "b"), (3, "?!", "c"), (1, None, "a"), (4, "wab fool dunce fool you " * 50_000, "d"), (5, "wab wac " * 100_000, None)]
    out = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, score string"), model).collect()
    assert len(out) == len(rows) and [r.score_in for r in sorted(out, key=lambda r: (r.doc_id, str(r.text)))].count("a") == 2
    by = {r.doc_id: r for r in out}
    assert by[4].predicted == 1 and by[5].predicted == 0 and by[1].predicted == 0
    assert by[1].score == by[2].score
    assert toxicity.score(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_calibration_never_falls(spark, learned):
    model, docs = learned
    table = toxicity._margin(model.trees.transform(toxicity._vector(toxicity.features(docs, model.lexicons))))
    rows = sorted((r["__margin"], r["__score"]) for r in model.calibration.transform(table).select("__margin", "__score").collect())
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(rows, rows[1:]))


def test_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    for marks, share in (([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0), ([], 0.0), ([(1, None)], 0.0)):
        labels = spark.createDataFrame(marks, "doc_id long, toxic int")
        assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()} == {share}
    assert toxicity.fit(docs.limit(0), labels).base == 0.0


def test_lexicon_does_not_see_its_fold(spark):
    rows = [(f"bad{f} common", 1.0, 1.0, f) for f in range(5) for _ in range(6)] + [(f"calm{f} words", 0.0, 1.0, f) for f in range(5) for _ in range(60)]
    rows = [(t.replace("0", "a").replace("1", "b").replace("2", "c").replace("3", "d").replace("4", "e"), *r) for t, *r in rows]
    lexicons = toxicity.learn_lexicons(spark.createDataFrame(rows, "text string, y double, weight double, fold int"))
    for f, letter in enumerate("abcde"):
        assert f"bad{letter}" not in lexicons[f] and f"bad{letter}" in lexicons[-1]
        assert "common" in lexicons[f] and not any("calm" in t for t in lexicons[f])


def test_sample_is_bounded_and_collapses_copies(spark):
    rows = [(i, "same text") for i in range(500)] + [(1000 + i, f"text {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(k, int(k % 2 or k >= 1050)) for k, _ in rows], "doc_id long, toxic int")
    got = toxicity._sample(docs, marks, "doc_id", "text", "toxic", 20).collect()
    counts = {y: [r.weight for r in got if r.y == y] for y in (0.0, 1.0)}
    assert {y: len(w) for y, w in counts.items()} == {0.0: 20, 1.0: 20}
    assert sum(map(sum, counts.values())) == pytest.approx(101)


def test_query_on_held_out_rows(spark):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in entry.queries()["op13_toxicity_trees"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out}
    assert sum(got[i].predicted == y for i, y in truth.items()) >= 0.95 * len(truth)
