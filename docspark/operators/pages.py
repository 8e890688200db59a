"""Documents to pages.

A document is one cell, so everything up to chunks stays in its row as arrays
and is exploded at the end: no shuffle between the scan and the chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions import scalars as S

# Fixed value: characters per page of a text without form feeds.
PAGE_CHARS = 3000

PAGE_STRUCT = "array<struct<page_number:int,start:int,end:int,text:string>>"


def page_array(text, page_chars: int = PAGE_CHARS) -> Column:
    """Pages of a text with character spans, as an array.

    Form feeds separate pages; without any, windows of ``page_chars``.  The
    regex cuts the text in one pass, where a substring per page would scan it
    again from the start for each one.
    """
    t = S._c(text)

    def windows(cut: Column) -> Column:
        return F.transform(
            cut,
            lambda p, i: F.struct(
                (i + 1).cast("int").alias("page_number"),
                (i * page_chars).cast("int").alias("start"),
                (i * page_chars + F.length(p)).cast("int").alias("end"),
                p.alias("text"),
            ),
        )

    def feeds(parts: Column) -> Column:
        # A page ends one character (its form feed) before the next begins.
        nexts = S.running_sum(F.transform(parts, lambda p: F.length(p) + 1))
        return F.transform(
            F.arrays_zip(parts.alias("p"), nexts.alias("n")),
            lambda z, i: F.struct(
                (i + 1).cast("int").alias("page_number"),
                (z["n"] - F.length(z["p"]) - 1).cast("int").alias("start"),
                (z["n"] - 1).cast("int").alias("end"),
                z["p"].alias("text"),
            ),
        )

    pieces = F.regexp_extract_all(t, F.lit(f"(?s).{{1,{page_chars}}}"), F.lit(0))
    return (
        F.when(t.contains("\f"), S.let(F.split(t, "\f"), feeds))
        .when(F.length(t) <= page_chars, windows(F.array(t)))
        .otherwise(windows(pieces))
        .cast(PAGE_STRUCT)
    )


def with_pages(docs: DataFrame, text: str = "text", page_chars: int = PAGE_CHARS) -> DataFrame:
    """Add ``pages`` and ``total_pages``; the document stays one row."""
    return docs.withColumn("pages", page_array(text, page_chars)).withColumn("total_pages", F.size("pages"))


def split_pages(docs: DataFrame, key: str = "doc_id", text: str = "text", page_chars: int = PAGE_CHARS) -> DataFrame:
    """One row per page: number (1-based), span, text, and the page total."""
    nested = with_pages(docs, text, page_chars)
    return S.unnest(nested, [key, "total_pages"], "pages", "p").select(key, "p.*", "total_pages")


def select_pages(pages: DataFrame, page_range) -> DataFrame:
    """Pages of a range text (a constant or a column); no range keeps every page."""
    rng = page_range if isinstance(page_range, Column) else F.lit(page_range)
    return pages.where(S.in_page_range("page_number", rng))


def keep_pages(docs: DataFrame, page_range: str) -> DataFrame:
    """The same on the nested form, per row, before any further work."""
    chosen = F.filter("pages", lambda p: S.in_page_range(p["page_number"], F.col(page_range)))
    return docs.withColumn("pages", chosen)
