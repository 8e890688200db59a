import pytest
from pyspark.sql import functions as F

from docspark.operators import chunks as C
from docspark.operators import fragments as G
from docspark.operators import pages as P

DOC = "\n".join([
    "A title",
    "x" * 50 + " plain text of the opening",
    "# One",
    "- item",
    "2) second",
    "## Two",
    "| a | b |",
    "y" * 60,
    "# Three",
    "~~gone~~",
    "page 3 of 9",
    "Signature: J. Doe",
    "z" * 45,
])


def doc(spark, text, n=1):
    return spark.createDataFrame([(i, text) for i in range(n)], "doc_id bigint, text string")


def nested(spark, text, chars=P.PAGE_CHARS):
    return G.with_fragments(P.with_pages(doc(spark, text), page_chars=chars))


def test_pages_by_window(spark):
    rows = P.split_pages(doc(spark, "aé😀" * 5), page_chars=4).orderBy("page_number").collect()
    assert "".join(r["text"] for r in rows) == "aé😀" * 5
    assert [(r["page_number"], r["start"], r["end"], r["total_pages"]) for r in rows] == [
        (1, 0, 4, 4), (2, 4, 8, 4), (3, 8, 12, 4), (4, 12, 15, 4),
    ]


def test_pages_by_form_feed(spark):
    text = "one\ftwo two\f\flast"
    rows = P.split_pages(doc(spark, text), page_chars=2).orderBy("page_number").collect()
    assert [r["text"] for r in rows] == ["one", "two two", "", "last"]
    assert all(text[r["start"]:r["end"]] == r["text"] for r in rows)


def test_empty_document_has_one_page_and_one_chunk(spark):
    n = nested(spark, "")
    assert P.split_pages(doc(spark, "")).count() == 1
    for strategy in ("none", "section"):
        assert [(r["chunk_no"], r["content"]) for r in C.chunk(n, strategy).collect()] == [(0, "")]
    assert G.explode_fragments(n).count() == 0


def test_long_document(spark):
    text = "line of text that is long enough to stay text\n" * 40_000
    n = nested(spark, text)
    assert n.select("total_pages").first()[0] == -(-len(text) // P.PAGE_CHARS)
    chunks = C.chunk(n, "page")
    assert chunks.count() == n.select("total_pages").first()[0]


def test_fragment_types(spark):
    rows = G.explode_fragments(nested(spark, DOC)).collect()
    assert [(r["fragment_type"], r["level"]) for r in rows] == [
        ("title", 0), ("text", None), ("section_header", 1), ("list_item", None), ("list_item", None),
        ("section_header", 2), ("table", None), ("text", None), ("section_header", 1), ("strikethrough", None),
        ("page_number", None), ("signature", None), ("text", None),
    ]
    assert [r["text"] for r in rows][2:5] == ["One", "item", "second"]
    assert [r["reading_order"] for r in rows] == list(range(13))


def test_flat_and_nested_fragments_agree(spark):
    flat = G.fragment_text(P.split_pages(doc(spark, DOC * 30)))
    assert flat.exceptAll(G.explode_fragments(nested(spark, DOC * 30))).count() == 0


def test_sections_and_headers(spark):
    n = nested(spark, DOC)
    assert [r["section_id"] for r in C.section_id(n).collect()] == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 4, 4]
    paths = [r["header_path"] for r in C.header_path(n).collect()]
    assert paths[0] == "A title" and paths[3] == "A title > One"
    assert paths[6] == "A title > One > Two" and paths[8] == "A title > Three"


def test_text_before_the_first_header_is_section_zero(spark):
    n = nested(spark, "w" * 90 + "\n# H\n" + "v" * 90)
    assert [(r["chunk_no"], r["content"][:4]) for r in C.chunk(n, "section").collect()] == [(0, "wwww"), (1, "## H")]


def test_headers_of_other_pages(spark):
    n = nested(spark, "# Top\f" + "w" * 90)
    assert [r["header_path"] for r in C.header_path(n).collect()] == ["Top", "Top"]
    assert [r["header_path"] for r in C.header_path(n, cross_page=False).collect()] == ["Top", ""]


def test_markdown(spark):
    md = C.to_markdown(nested(spark, DOC)).first()["markdown"].split("\n\n")
    assert md[0] == "# A title" and md[2] == "## One" and md[3] == "- item" and md[5] == "### Two" and md[9] == "~~gone~~"


def test_patterns(spark):
    n = nested(spark, "\n".join(["skip", "BEGIN 1", "a", "END", "skip", "BEGIN 2", "b", "BEGIN 3", "c"]))
    both = C.partition(n, "patterns", "^BEGIN", "^END").orderBy("partition_no").collect()
    assert [(r["partition_no"], r["text"]) for r in both] == [
        (1, "BEGIN 1\na\nEND"), (2, "BEGIN 2\nb"), (3, "BEGIN 3\nc"),
    ]
    assert C.partition(n, "patterns", "^NOPE", "^END").count() == 0


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        C.chunk(nested(spark, "x"), "semantic")


def html(spark, markup):
    df = spark.createDataFrame([(1, markup)], "page_id int, html string")
    return [(r["fragment_type"], r["level"], r["text"]) for r in G.fragment_html(df).collect()]


def test_html(spark):
    got = html(spark, """<html><head><title>t</title></head><body><!-- <p>no</p> --><script>var a="</p>";</script>
      <nav><ul><li>x</li><li>y</li></ul></nav><h1>Big &amp; <i>bold</i></h1><p><b>open<br><p>next &lt;p&gt;
      <h3>Sub</h3><ul><li>one<li>two</ul><div>box</div><table><tr><td>1</td></tr></table>
      <img src=a alt="a picture"><figure><img alt="z"><figcaption>cap</figcaption></figure><footer>&copy; me</footer></body>""")
    assert got == [
        ("page_header", None, "x y"), ("title", 0, "Big & bold"), ("text", None, "open"), ("text", None, "next <p>"),
        ("section_header", 2, "Sub"), ("list_item", None, "one"), ("list_item", None, "two"), ("text", None, "box"),
        ("table", None, "1 |"), ("figure", None, "a picture"), ("figure", None, "cap"), ("page_footer", None, "© me"),
    ]


def test_strikethrough_and_ignored_types(spark):
    frags = G.explode_fragments(nested(spark, "keep ~~cut~~ this <s>word</s> here and more text to be long\n~~all~~"))
    assert [r["text"] for r in G.remove_strikethrough(frags).collect()] == ["keep  this  here and more text to be long"]
    assert G.ignore_sections(frags).count() == 2
    assert G.ignore_sections(frags, ["strikethrough"]).count() == 1


def test_content_union_has_one_member(spark):
    kinds = ["text", "title", "section_header", "table", "figure", "signature", "list_item"]
    df = spark.createDataFrame([(k, "t", 1) for k in kinds], "k string, t string, l int")
    for r in df.select("k", G.content_struct("k", "t", "l").alias("c")).collect():
        assert sum(v is not None for v in r["c"]) == 1
    assert df.select(G.content_struct("k", "t", "l")["header"]["level"].alias("x")).where(F.col("x") == 1).count() == 2


def test_html_table_rows_and_cells(spark):
    from docspark.operators import tables as T

    got = html(spark, "<body><table><thead><tr><th>A &amp; B<th> C <tbody><tr><td>1|2</td><td></td></tr><tr><td>x<td>y</table>"
                      "<table><caption>no rows</caption></table></body>")
    assert [t for _, _, t in got] == ["A & B | C |\n1\\|2 |  |\nx | y |", "no rows"]
    df = spark.createDataFrame([(got[0][2],), ("a | b\n|---|:-:|\nc | d",)], "t string")
    assert [r[0] for r in df.select(T.table_rows_of("t")).collect()] == [
        [["A & B", "C"], ["1|2", ""], ["x", "y"]], [["a", "b"], ["c", "d"]]]
