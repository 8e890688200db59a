import random
import re
from collections import Counter, defaultdict

import pytest

from compare import connect, differences
from docspark.llm import divergence


def plain_audit(rows, min_docs, top=50):
    """The contract by dictionaries over all kept terms."""
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs, counts, out = defaultdict(Counter), defaultdict(Counter), []
    for lang, source, text in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(lower))
        docs[lang].update(set(words))
        counts[lang, source].update(words)
    groups = sorted({r[:2] for r in rows})
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        mine = [s for g, s in groups if g == lang]
        v = len(kept)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * v) for t in kept}

        p = {s: shares(counts[lang, s]) for s in mine}
        q = shares(sum((counts[lang, s] for s in mine), Counter()))
        for s in mine:
            pairs = [(b, sum(abs(p[s][t] - p[b][t]) for t in kept)) for b in mine if b != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, f, k) for k, (i, f) in enumerate(found[:most], 1)]
    return sorted(out)


def corpus(seed, n, sources=6):
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("Ab", "é", "x", "漢", "Zü", "q") for b in ("a", "bE", "ß", "🙂", "c")]
    rows = []
    for _ in range(n):
        lang, source = rnd.choice(["en", "de", None, ""]), rnd.choice([*(f"s{i}" for i in range(sources)), None, "é"])
        rows.append((lang, source, rnd.choice([" ", "1", "_", "\n\x00", "-"]).join(rnd.choices(vocabulary, k=rnd.randint(0, 12)))))
    copies = [(rnd.choice(["en", "de"]), f"s{rnd.randrange(sources)}", "Ab aba é same Text") for _ in range(n)]
    return rows + copies + rows[: n // 4] + [("en", "s0", None), ("fr", "alone", "a b"), ("es", "x", ""), ("es", "y", None)]


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "other", i) for i, r in enumerate(rows)], "lang string, source string, text string, term string, p long").repartition(4)


@pytest.mark.parametrize("min_docs", [1, 8, 30])
def test_equals_plain_audit(spark, min_docs):
    rows = corpus(min_docs, 150)
    assert result(divergence.audit(frame(spark, rows), min_docs=min_docs, top=7)) == plain_audit(rows, min_docs, 7)


def test_small_blocks_lists_and_parts_change_nothing(spark, monkeypatch):
    rows = corpus(3, 120, sources=9)
    for name, value in (("BUCKET_TERMS", 3), ("BLOCK_SOURCES", 2), ("LISTED", 2), ("BROADCAST_BYTES", 0)):
        monkeypatch.setattr(divergence, name, value)
    assert result(divergence.audit(frame(spark, rows), min_docs=2)) == plain_audit(rows, 2)


def test_counts_passed_on_in_parts(spark):
    rows = [("en", f"s{i % 3}", f"word{i} common long" + " x" * (i % 5)) for i in range(60)]
    texts, groups = divergence.collapse(divergence._documents(frame(spark, rows), "lang", "source", "text"))
    want = result(divergence.audit(frame(spark, rows), min_docs=2))
    assert want == plain_audit(rows, 2) and groups.count() == 3 and texts.count() == len({r[2] for r in rows})


def test_each_text_is_tokenised_once(spark):
    rows = [("en", f"s{i % 4}", "the same words") for i in range(400)] + [("de", "s0", "the same words"), ("en", "s0", "other")]
    texts, _ = divergence.collapse(divergence._documents(frame(spark, rows), "lang", "source", "text"))
    got = {(r.lang, r.text): {m.source: m.m for m in r["mult"]} for r in texts.collect()}
    assert got == {("en", "the same words"): {f"s{i}": 100 for i in range(4)}, ("de", "the same words"): {"s0": 1}, ("en", "other"): {"s0": 1}}


def test_counts_beyond_64_bits_stay_exact(spark):
    n = 10**11
    df = spark.createDataFrame([(n, 3 * n, 7)], "c long, n long, v long")
    got = df.select(divergence.share(df.c, df.n, df.v)).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (3 * n + 35)


def test_long_texts_and_empty_table(spark):
    rows = [("en", "a", "long words here " * 60_000), ("en", "b", "long"), ("en", "c", "!")]
    assert result(divergence.audit(frame(spark, rows), min_docs=1)) == plain_audit(rows, 1)
    assert divergence.audit(frame(spark, rows).limit(0)).count() == 0


def test_query_against_sql(spark, sf_dir):
    import __spark_entry__ as entry

    name = "op12_source_divergence"
    assert differences(entry.queries()[name](spark, sf_dir), connect(sf_dir), entry.oracle_sql()[name]) is None
