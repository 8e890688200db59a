"""Sections, header paths, markdown, chunks and partitions.

Input is the nested document row (``key, fragments``) with fragments in reading
order.  Sections are array slices between header positions, so neither a
window nor a shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions import scalars as S
from docspark.operators.fragments import HEADERS
from docspark.schemas import CHUNKING_STRATEGIES, PARTITION_STRATEGIES

MAX_LEVEL = 6


def markdown_line(f: Column) -> Column:
    """One fragment as markdown."""
    kind, text = f["fragment_type"], f["text"]
    return (
        F.when(kind == "title", F.concat(F.lit("# "), text))
        .when(kind == "section_header", F.concat(F.repeat(F.lit("#"), f["level"] + 1), F.lit(" "), text))
        .when(kind == "list_item", F.concat(F.lit("- "), text))
        .when(kind == "strikethrough", F.concat(F.lit("~~"), F.regexp_replace(text, r"~~|</?(s|del)>", ""), F.lit("~~")))
        .otherwise(text)
    )


def markdown(frags) -> Column:
    """A run of fragments as markdown, blank line between them."""
    return F.array_join(F.transform(S._c(frags), markdown_line), "\n\n")


def is_header(f: Column) -> Column:
    return f["fragment_type"].isin(*HEADERS)


def positions(frags: Column, test) -> Column:
    """1-based positions of the fragments that pass ``test(fragment, index)``."""
    marks = F.transform(frags, lambda x, i: F.when(test(x, i), (i + 1).cast("int")))
    return F.filter(marks, lambda p: p.isNotNull())


def cut_at(frags: Column, starts: Column, first_no: Column) -> Column:
    """Slices ``frags[start_i .. start_{i+1})`` numbered from ``first_no``."""

    def slices_at(at: Column) -> Column:
        return F.transform(
            at,
            lambda s, i: F.struct(
                (first_no + i).cast("int").alias("no"),
                F.slice(frags, s, F.coalesce(F.get(at, i + 1), F.size(frags) + 1) - s).alias("frags"),
            ),
        )

    return S.let(starts, slices_at)


def section_slices(frags) -> Column:
    """Sections as ``[{no, frags}]``; text before the first header is section 0.

    A document without fragments has one empty section.
    """
    f = S._c(frags)
    lead = ~F.coalesce(is_header(F.get(f, F.lit(0))), F.lit(False))
    opening = F.when(lead, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    starts = F.concat(opening, positions(f, lambda x, i: is_header(x)))
    return cut_at(f, starts, F.when(lead, 0).otherwise(1))


def page_slices(frags) -> Column:
    """One slice per page."""
    f = S._c(frags)
    turns = positions(f, lambda x, i: (i == 0) | (x["page_number"] != F.get(f, i - 1)["page_number"]))
    return cut_at(f, turns, F.lit(0))


def fragment_slices(frags) -> Column:
    return F.transform(
        S._c(frags), lambda x, i: F.struct(i.cast("int").alias("no"), F.array(x).alias("frags"))
    )


def whole_slice(frags) -> Column:
    return F.array(F.struct(F.lit(0).alias("no"), S._c(frags).alias("frags")))


def _matches(f: Column, pattern: str | Column) -> Column:
    return F.rlike(f["text"], F.lit(pattern) if isinstance(pattern, str) else pattern)


def pattern_slices(frags, start: str | Column, end: str | Column | None = None) -> Column:
    """Regions from a start line to the first end line after it, both included.

    A new start closes the open region.  Lines outside regions are dropped; a
    region without an end runs to the next start or the end of the document.
    Patterns may be values of the row; an end that is NULL there matches nothing.
    """
    f = S._c(frags)
    regions = cut_at(f, positions(f, lambda x, i: _matches(x, start)), F.lit(1))
    if end is None or (isinstance(end, str) and not end):
        return regions

    def close(r: Column) -> Column:
        ends = positions(r["frags"], lambda x, i: _matches(x, end))
        upto = F.coalesce(F.get(ends, F.lit(0)), F.size(r["frags"]))
        return F.struct(r["no"].alias("no"), F.slice(r["frags"], 1, upto).alias("frags"))

    return F.transform(regions, close)


def slices(frags, strategy: str, start: str | None = None, end: str | None = None) -> Column:
    if strategy not in PARTITION_STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "patterns":
        return pattern_slices(frags, start, end)
    make = {"none": whole_slice, "page": page_slices, "section": section_slices, "fragment": fragment_slices}
    return make[strategy](frags)


def slices_by(frags, strategy: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """Slices by a strategy that is a value of the row; ``patterns`` needs ``start``."""
    cut = (
        F.when(strategy == "page", page_slices(frags))
        .when(strategy == "section", section_slices(frags))
        .when(strategy == "fragment", fragment_slices(frags))
    )
    if start is not None:
        cut = cut.when(strategy == "patterns", pattern_slices(frags, start, end))
    return cut.otherwise(whole_slice(frags))


def partition(
    docs: DataFrame, strategy: str = "none", start: str | None = None, end: str | None = None, key: str = "doc_id"
) -> DataFrame:
    """One row per partition: number, its pages, its text, its fragments."""
    cut = slices("fragments", strategy, start, end)
    return docs.select(key, F.explode(cut).alias("s")).select(
        key,
        F.col("s.no").alias("partition_no"),
        F.array_sort(F.array_distinct(F.transform("s.frags", lambda f: f["page_number"]))).alias("page_numbers"),
        F.array_join(F.transform("s.frags", lambda f: f["text"]), "\n").alias("text"),
        F.col("s.frags").alias("fragments"),
    )


def chunk(docs: DataFrame, strategy: str = "none", key: str = "doc_id") -> DataFrame:
    """Chunks in markdown; ``page_number`` is the chunk's first page.

    ``none`` still gives one chunk, even for a document without fragments.
    """
    if strategy not in CHUNKING_STRATEGIES:
        raise ValueError(f"unknown chunking strategy {strategy!r}")
    return docs.select(key, F.explode(slices("fragments", strategy)).alias("s")).select(
        key,
        F.col("s.no").alias("chunk_no"),
        F.coalesce(F.get(F.col("s.frags"), F.lit(0))["page_number"], F.lit(0)).alias("page_number"),
        markdown(F.col("s.frags")).alias("content"),
    )


def chunk_by_column(docs: DataFrame, strategy: str, key: str = "doc_id") -> DataFrame:
    """Chunks where each document names its own strategy in a column."""
    cut = slices_by("fragments", F.col(strategy))
    return docs.select(key, F.explode(cut).alias("s")).select(
        key,
        F.col("s.no").alias("chunk_no"),
        F.coalesce(F.get(F.col("s.frags"), F.lit(0))["page_number"], F.lit(0)).alias("page_number"),
        markdown(F.col("s.frags")).alias("content"),
    )


def to_markdown(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    return docs.select(key, markdown("fragments").alias("markdown"))


def section_id(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Flat fragments, each with the number of its section."""
    return (
        docs.select(key, F.explode(section_slices("fragments")).alias("s"))
        .select(key, F.col("s.no").alias("section_id"), F.explode("s.frags").alias("f"))
        .select(key, "section_id", "f.*")
    )


def _split_level(groups: Column, level: int) -> Column:
    """Cut ``[{path, frags}]`` at the headers of one level; each part's path gets that level's header or NULL.

    Shallower levels are cut before, so inside a group a header of this level
    holds up to the next one: every level reads the fragments once.
    """

    def starts(f: Column) -> Column:
        marks = positions(f, lambda x, i: is_header(x) & (x["level"] == level))
        first = F.coalesce(F.get(marks, F.lit(0)), F.lit(0))
        return F.concat(F.when(first == 1, F.array().cast("array<int>")).otherwise(F.array(F.lit(1))), marks)

    def cut(g: Column) -> Column:
        def part(s: Column) -> Column:
            head = F.get(s["frags"], F.lit(0))
            own = F.when(is_header(head) & (head["level"] == level), head["text"])
            return F.struct(F.concat(g["path"], F.array(own)).alias("path"), s["frags"].alias("frags"))

        return F.transform(cut_at(g["frags"], starts(g["frags"]), F.lit(0)), part)

    return F.flatten(F.transform(groups, cut))


def header_path(docs: DataFrame, cross_page: bool = True, key: str = "doc_id") -> DataFrame:
    """Flat fragments with the chain of headers above each.

    Without ``cross_page`` only headers of the same page count.  The document
    is cut level by level, so the work is linear in its fragments, and the
    document stays one row until its fragments are taken apart.
    """
    units = docs.select(
        key,
        (
            F.array(F.col("fragments").alias("frags")) if cross_page
            else F.transform(page_slices("fragments"), lambda s: s["frags"])
        ).alias("units"),
    )
    no_path = F.array().cast("array<string>")
    groups = F.transform("units", lambda u: F.struct(no_path.alias("path"), u.alias("frags")))
    for level in range(MAX_LEVEL + 1):
        groups = _split_level(groups, level)
    return (
        S.unnest(units.select(key, groups.alias("groups")), [key], "groups", "g")
        .select(
            key,
            F.concat_ws(" > ", F.filter("g.path", lambda t: t.isNotNull())).alias("header_path"),
            F.explode("g.frags").alias("f"),
        )
        .select(key, "header_path", "f.*")
    )


def chunk_stats(chunks: DataFrame, by: str) -> DataFrame:
    """Chunk count and sizes per group."""
    size = F.length("content")
    return chunks.groupBy(by).agg(
        F.count(F.lit(1)).alias("chunks"),
        F.sum(size).alias("chars"),
        F.max(size).alias("longest"),
    )
