"""Pages to typed fragments, for text and for HTML."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions import scalars as S

# Line rules of text documents, tried in this order on the trimmed line.
SIGNATURE_LINE = r"(?i)^(signature|signed by|signed)[ \t]*:"
SIGNATURE_MARK = "/s/"
SIGNATURE_RULE = "________"
PAGE_NUMBER_LINE = r"(?i)^(page[ \t]+[0-9]+([ \t]+of[ \t]+[0-9]+)?|-[ \t]*[0-9]+[ \t]*-)$"
LIST_LINE = r"^([-*+]|[0-9]{1,3}[.)])[ \t]+"
HASH_LINE = r"^#{1,6}[ \t]+"
STRUCK_LINE = r"^(~~.*~~|<(s|del)>.*</(s|del)>)$"
STRUCK_TEXT = r"~~[^~]*~~|<s>[^<]*</s>|<del>[^<]*</del>"
KEY_VALUE_LINE = r"^[A-Za-z0-9_ ]+:[ \t]*[^ \t]"
TITLE_CHARS = 80
HEADER_CHARS = 40
HEADERS = ("title", "section_header")


def line_type(
    line: Column, opens_document: Column, signatures: bool | Column = True, struck: bool | Column = True,
    key_values: bool | Column = False,
) -> Column:
    """Fragment type of one trimmed, non-blank line.  Detections that are off leave other types.

    A detection is switched for the whole table, or by a column for each row.

    A pattern is only tried on a line that starts like it, so a line of prose
    costs a few byte comparisons and no regex.
    """
    def starts(*prefixes: str) -> Column:
        return reduce(or_, [line.startswith(p) for p in prefixes])

    n = F.length(line)
    signature = (starts("s", "S") & line.rlike(SIGNATURE_LINE)) | starts(SIGNATURE_MARK.lower(), SIGNATURE_MARK.upper())
    listed = (starts("-", "*", "+") | ((line >= "0") & (line < ":"))) & line.rlike(LIST_LINE)
    rules = [
        (signatures, signature | line.contains(SIGNATURE_RULE), "signature"),
        (True, starts("p", "P", "-") & line.rlike(PAGE_NUMBER_LINE), "page_number"),
        (struck, starts("~~", "<") & line.rlike(STRUCK_LINE), "strikethrough"),
        (True, line.contains("|"), "table"),
        (True, listed, "list_item"),
        (True, starts("#") & line.rlike(HASH_LINE), "section_header"),
        (key_values, line.contains(":") & line.rlike(KEY_VALUE_LINE), "key_value_region"),
        (True, opens_document & (n <= TITLE_CHARS), "title"),
        (True, n <= HEADER_CHARS, "section_header"),
    ]
    kind = F.lit("text")
    for on, rule, name in reversed(rules):
        if on is not False:
            kind = F.when(rule if on is True else on & rule, name).otherwise(kind)
    return kind


def _place(start: Column, text: Column, source: Column) -> list[Column]:
    """Where a fragment stands in its document, and the text there if the fragment's own is a different one."""
    return [start.cast("int").alias("start"), F.when(source != text, source).alias("source")]


def _leading_blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.ltrim(text, F.lit(S.BLANKS)))


def _shape(x: Column, offsets: bool = False) -> Column:
    """Fragment struct; markers of headers and list items are not content."""
    line, kind = x["line"], x["kind"]
    hashes = F.length(F.regexp_extract(line, r"^(#{1,6})[ \t]+", 1))
    level = F.when(kind == "title", 0).when(kind == "section_header", F.greatest(hashes, F.lit(1)))
    body = (
        F.when(kind == "section_header", F.regexp_replace(line, HASH_LINE, ""))
        .when(kind == "list_item", F.regexp_replace(line, LIST_LINE, ""))
        .otherwise(line)
    )
    return F.struct(
        x["page"].cast("int").alias("page_number"),
        x["order"].cast("int").alias("reading_order"),
        kind.alias("fragment_type"),
        level.cast("int").alias("level"),
        body.alias("text"),
        # Markers stand before the content, so its place is counted from the line's end.
        *(_place(x["start"] + F.length(line) - F.length(body), body, body) if offsets else []),
    )


def page_fragments(pages, offsets: bool = False, **detect: bool | Column) -> Column:
    """Fragments of each page, as one array per page next to ``pages``.

    ``reading_order`` counts the non-blank lines of a page from 0.  With
    ``offsets`` every fragment carries ``start``, its place in the document
    counted from the page's ``start``, and ``source``.
    """

    def placed(p: Column, lines: Column) -> Column:
        ends = S.running_sum(F.transform(lines, lambda x: F.length(x) + 1))
        return F.transform(
            F.arrays_zip(lines.alias("x"), ends.alias("e")),
            lambda z: F.struct(
                S.trimmed(z["x"]).alias("line"), (p["start"] + z["e"] - 1 - F.length(z["x"]) + _leading_blanks(z["x"])).alias("start")),
        )

    def of_page(p: Column) -> Column:
        split = F.split(p["text"], "\n")
        if offsets:
            lines = F.filter(S.let(split, lambda x: placed(p, x)), lambda x: x["line"] != "")
        else:
            lines = F.filter(F.transform(split, S.trimmed), lambda x: x != "")

        def typed(x: Column, i: Column) -> Column:
            line = x["line"] if offsets else x
            return F.struct(
                p["page_number"].alias("page"),
                i.alias("order"),
                line.alias("line"),
                line_type(line, (p["page_number"] == 1) & (i == 0), **detect).alias("kind"),
                *([x["start"].alias("start")] if offsets else []),
            )

        return F.transform(F.transform(lines, typed), lambda x: _shape(x, offsets))

    return F.transform(S._c(pages), of_page)


def whole_pages(pages, offsets: bool = False) -> Column:
    """Every page as one text fragment: layout detection is off."""

    def of_page(p: Column) -> Column:
        text = S.trimmed(p["text"])
        one = F.struct(
            p["page_number"].alias("page_number"),
            F.lit(0).alias("reading_order"),
            F.lit("text").alias("fragment_type"),
            F.lit(None).cast("int").alias("level"),
            text.alias("text"),
            *(_place(p["start"] + _leading_blanks(p["text"]), text, text) if offsets else []),
        )
        return F.filter(F.array(one), lambda f: f["text"] != "")

    return F.transform(S._c(pages), of_page)


def text_fragments(pages) -> Column:
    """All fragments of a document as one array in reading order."""
    return F.flatten(page_fragments(pages))


def with_fragments(docs: DataFrame) -> DataFrame:
    """Add ``fragments`` to a document row that has ``pages``."""
    return docs.withColumn("fragments", text_fragments("pages"))


def explode_fragments(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Flat table of a nested ``fragments`` column."""
    return S.unnest(docs, [key], "fragments", "f").select(key, "f.*")


def fragment_text(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """Flat page rows to flat fragment rows; row-local."""
    one = F.array(F.struct("page_number", "text"))
    frags = text_fragments(one)
    return pages.select(key, F.explode(frags).alias("f")).select(key, "f.*")


# ---- HTML ----------------------------------------------------------------

# Markup rules.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>"
CONTAINERS = r"(?is)(<nav\b.*?</nav>|<footer\b.*?</footer>|<table\b.*?</table>|<figure\b.*?</figure>)"
IS_CONTAINER = r"(?i)^<(nav|footer|table|figure)\b"
BLOCK_OPEN = r"(?i)(<(?:h[1-6]|p|li|img|div)\b)"
BLOCK_CLOSE = r"(?is)</(?:h[1-6]|p|li|div|article|section|ul|ol|body|html)>.*$"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
            ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def html_text(markup: Column) -> Column:
    """Visible text of some markup: tags out, entities decoded, blanks collapsed."""
    t = F.regexp_replace(markup, r"<[^>]*>", " ")
    for name, char in ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(t, r"[ \t\r\n]+", " "))


def html_visible(html) -> Column:
    """The whole visible text of a page."""
    return html_text(F.regexp_replace(S._c(html), HIDDEN, ""))


def html_segments(html) -> Column:
    """Markup cut at block elements, in document order.

    Navigation, footers, tables and figures stay whole.  Cutting at *opening*
    tags means an unclosed paragraph ends where the next block starts.
    """
    clean = F.regexp_replace(S._c(html), HIDDEN, "")
    parts = F.split(F.regexp_replace(clean, CONTAINERS, "\u0002$1\u0002"), "\u0002")

    def cut(part: Column) -> Column:
        blocks = F.split(F.regexp_replace(part, BLOCK_OPEN, "\u0001$1"), "\u0001")
        return F.when(part.rlike(IS_CONTAINER), F.array(part)).otherwise(blocks)

    return F.flatten(F.transform(parts, cut))


def html_type(segment: Column) -> Column:
    s = segment
    return (
        F.when(s.rlike(r"(?i)^<nav\b"), "page_header")
        .when(s.rlike(r"(?i)^<footer\b"), "page_footer")
        .when(s.rlike(r"(?i)^<table\b"), "table")
        .when(s.rlike(r"(?i)^<(figure|img)\b"), "figure")
        .when(s.rlike(r"(?i)^<h1\b"), "title")
        .when(s.rlike(r"(?i)^<h[2-6]\b"), "section_header")
        .when(s.rlike(r"(?i)^<li\b"), "list_item")
        .when(s.rlike(r"(?i)^<(p|div)\b"), "text")
    )


CELL_END = r"(?is)</?(?:td|th|tr|table|thead|tbody|tfoot|caption)\b.*$"


def html_table_text(markup: Column) -> Column:
    """A ``<table>`` as lines of cells between vertical bars; bars inside cells are escaped.

    Rows and cells begin at their opening tags, so unclosed ones end where the
    next begins; header cells are cells.  A table without rows is its text.
    """

    def cell(c: Column) -> Column:
        return F.replace(html_text(F.regexp_replace(c, CELL_END, "")), F.lit("|"), F.lit("\\|"))

    def row(r: Column) -> Column:
        cells = F.split(F.regexp_replace(r, r"(?i)<t[dh]\b[^>]*>", "\u0001"), "\u0001")
        return F.array_join(F.transform(F.slice(cells, 2, F.size(cells)), cell), " | ")

    def lines(parts: Column) -> Column:
        rows = F.transform(F.slice(parts, 2, F.size(parts)), row)
        # A bar at the end keeps a row of one cell a row of a table.
        return F.when(F.size(parts) > 1, F.array_join(F.transform(rows, lambda r: F.concat(r, F.lit(" |"))), "\n"))

    return S.let(F.split(F.regexp_replace(markup, r"(?i)<tr\b[^>]*>", "\u0002"), "\u0002"), lines)


def html_fragments(html, offsets: bool = False) -> Column:
    """Typed fragments of a fetched page (one page per URL) as one array.

    With ``offsets`` every fragment carries its place in the page's visible
    text: the segments' own visible texts, one blank apart, are that text.
    """

    def shape(x: Column) -> Column:
        seg, kind = x["seg"], x["kind"]
        level = F.when(kind == "title", 0).when(
            kind == "section_header", F.regexp_extract(seg, r"(?i)^<h([2-6])", 1).cast("int") - 1
        )
        body = F.when(seg.rlike(IS_CONTAINER), seg).otherwise(F.regexp_replace(seg, BLOCK_CLOSE, ""))
        alt = F.regexp_extract(seg, r"""(?i)^<img\b[^>]*\balt="([^"]*)""", 1)
        table = F.when(kind == "table", html_table_text(seg))
        text = F.when(seg.rlike(r"(?i)^<img\b"), html_text(alt)).otherwise(F.coalesce(table, html_text(body)))
        return F.struct(
            kind.alias("fragment_type"), level.cast("int").alias("level"), text.alias("text"),
            *(_place(x["end"] - 1 - F.length(x["seen"]), text, x["seen"]) if offsets else []))

    def placed(segs: Column) -> Column:
        ends = S.running_sum(F.transform(segs, lambda x: F.when(x["seen"] == "", 0).otherwise(F.length(x["seen"]) + 1)))
        return F.transform(F.arrays_zip(segs.alias("s"), ends.alias("e")), lambda z: z["s"].withField("end", z["e"]))

    segments = F.transform(html_segments(html), lambda s: F.struct(
        s.alias("seg"), html_type(s).alias("kind"), *([html_text(s).alias("seen")] if offsets else [])))
    if offsets:
        segments = S.let(segments, placed)
    typed = F.filter(
        F.transform(F.filter(segments, lambda x: x["kind"].isNotNull()), shape), lambda f: f["text"] != ""
    )
    return F.transform(
        typed,
        lambda f, i: F.struct(
            F.lit(1).cast("int").alias("page_number"),
            i.cast("int").alias("reading_order"),
            f["fragment_type"].alias("fragment_type"),
            f["level"].alias("level"),
            f["text"].alias("text"),
            *([f["start"].alias("start"), f["source"].alias("source")] if offsets else []),
        ),
    )


def fragment_html(web: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return explode_fragments(web.select(key, html_fragments(html).alias("fragments")), key)


# ---- filters on fragments ------------------------------------------------

def ignore_sections(frags: DataFrame, types: Sequence[str] = ()) -> DataFrame:
    """Drop fragments of the given types; the default drops nothing."""
    return frags.where(~F.col("fragment_type").isin(*types)) if types else frags


def keep_fragments(docs: DataFrame, ignored: str) -> DataFrame:
    """The same per row on the nested form; ``ignored`` names an array column."""
    skip = F.coalesce(F.col(ignored), F.array().cast("array<string>"))
    kept = F.filter("fragments", lambda f: ~F.array_contains(skip, f["fragment_type"]))
    return docs.withColumn("fragments", kept)


def unstruck(text) -> Column:
    return F.trim(F.regexp_replace(S._c(text), STRUCK_TEXT, ""))


def remove_strikethrough(frags: DataFrame) -> DataFrame:
    """Drop struck fragments and cut struck passages out of the others."""
    return frags.where(F.col("fragment_type") != "strikethrough").withColumn("text", unstruck("text"))


def page_signatures(frags: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per page: is there a signature line, and how many."""
    signed = F.col("fragment_type") == "signature"
    return frags.groupBy(key, "page_number").agg(F.count_if(signed).alias("signatures")).withColumn(
        "signed", F.col("signatures") > 0
    )


# ---- the content union ---------------------------------------------------

def content_struct(kind, text, level, summary=None, cells=None, html=None, markdown=None) -> Column:
    """Content union: exactly one member is set.  Only built at the sink."""
    k, t = S._c(kind), S._c(text)
    note = F.lit(None).cast("string") if summary is None else S._c(summary)
    cell_type = "array<struct<text:string,bounding_box:map<string,double>>>"
    cell_list = F.lit(None).cast(cell_type) if cells is None else S._c(cells)
    as_html = F.lit(None).cast("string") if html is None else S._c(html)
    as_md = F.lit(None).cast("string") if markdown is None else S._c(markdown)
    header, table = k.isin(*HEADERS), k == "table"
    figure, sign = k.isin("figure", "chart"), k == "signature"
    plain = ~(header | table | figure | sign)
    return F.struct(
        F.when(plain, F.struct(t.alias("content"))).alias("text"),
        F.when(header, F.struct(t.alias("content"), S._c(level).cast("int").alias("level"))).alias("header"),
        F.when(
            table,
            F.struct(
                t.alias("content"), cell_list.alias("cells"), as_html.alias("html"),
                as_md.alias("markdown"), note.alias("summary"),
            ),
        ).alias("table"),
        F.when(figure, F.struct(t.alias("content"), note.alias("summary"))).alias("figure"),
        F.when(sign, F.struct(t.alias("content"))).alias("signature"),
    )
