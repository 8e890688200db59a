import hashlib
import re

import pytest

from compare import connect, differences
from docspark.llm import fim

LONG = "".join(f"line {i} é\n" for i in range(60_000))
TEXTS = ["one\ntwo\nthree", "one", "\n", "\n\n\n", "a\n", "", None, "has <S> inside\nx", "é\nüß\n漢字\n🙂", "<\nP>\n<", "<S\n>", "M>\n<M", LONG]


def plain_rule(key, text, seed=7, rate=100, spm=50):
    """The contract, by plain string operations."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i: i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rule", [fim.Rule(), fim.Rule(11, 60, 20)])
def test_equals_plain_strings_and_restores(spark, rule):
    rows = [(k, t, "mine") for k in (*range(40), -5, None) for t in TEXTS]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string").repartition(5)
    out = fim.restore(fim.transform(df, rule=rule)).collect()
    assert len(out) == len(rows) and {r.form_in for r in out} == {"mine"}
    forms = set()
    for r in out:
        want = plain_rule(r.doc_id, r.text, rule.seed, rule.rate, rule.spm)
        assert (r.n_lines, r.form, r.prefix_chars, r.middle_chars, r.fim_text) == want
        assert r.output_sha256 == hashlib.sha256(want[4].encode()).hexdigest()
        assert r.restored_text == (r.text or "")
        assert r.restored_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}


def test_pieces_are_descriptors():
    data = b"ab\ncd\nef"
    pieces = fim.cut(0, [3, 6, 8], 1, 2)
    assert pieces == ((fim.TEXT, 0, 3), (fim.TEXT, 6, 8), (fim.TEXT, 3, 6))
    for form, text in (("psm", b"<P>ab\n<S>ef<M>cd\n"), ("spm", b"<S>ef<P>ab\n<M>cd\n")):
        assert b"".join(fim.stream(fim.arrange(pieces, form), memoryview(data))) == text
        back = fim.invert(fim.locate(memoryview(text), form), form)
        assert b"".join(fim.stream(back, memoryview(text))) == data


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = fim.restore(fim.transform(df), keep_text=False)
    assert out.count() == 0
    assert out.columns == ["doc_id", "text", *fim.OUTS, "restored_sha256"]


def test_damaged_output_is_an_error(spark):
    df = spark.createDataFrame([("no sentinel", "psm")], "fim_text string, form string")
    with pytest.raises(Exception):
        fim.restore(df).collect()


def test_query_against_sql(spark, sf_dir):
    import __spark_entry__ as entry

    name = "op11_piece_table_fim"
    assert differences(entry.queries()[name](spark, sf_dir), connect(sf_dir), entry.oracle_sql()[name]) is None
