"""Table rendering, merging across pages, and summaries.

Input: table rows ``(key, page_number, row_no, cells array<string>)``, one table
per page.  Everything collected into one value is bounded by one page, or by
``PART_PAGES`` pages for merged tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions import scalars as S
from docspark.operators import hotkeys
from docspark.schemas import TABLE_OUTPUT_MODES

PART_PAGES = 1000


def escape_html(cell: Column) -> Column:
    out = cell
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def html_row(cells) -> Column:
    inner = F.array_join(
        F.transform(S._c(cells), lambda c: F.concat(F.lit("<td>"), escape_html(c), F.lit("</td>"))), ""
    )
    return F.concat(F.lit("<tr>"), inner, F.lit("</tr>"))


def html_table(rows) -> Column:
    """Rows of cells as one HTML table."""
    return F.concat(F.lit("<table>"), F.array_join(F.transform(S._c(rows), html_row), ""), F.lit("</table>"))


def markdown_row(cells) -> Column:
    inner = F.array_join(F.transform(S._c(cells), lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))), " | ")
    return F.concat(F.lit("| "), inner, F.lit(" |"))


def table_cells_of(line) -> Column:
    """Cells of a text line with vertical bars; an escaped bar belongs to its cell."""
    bare = F.regexp_replace(S.trimmed(line), r"^\||(?<!\\)\|$", "")
    return F.transform(F.split(bare, r"(?<!\\)\|"), lambda c: F.replace(S.trimmed(c), F.lit("\\|"), F.lit("|")))


# The line under a table's header: bars, dashes and colons only.
RULE_LINE = r"^[ \t|:-]*-[ \t|:-]*$"


def table_rows_of(text) -> Column:
    """Rows of cells of a table's lines, without the line that rules off its header."""
    lines = F.filter(F.split(S._c(text), "\n"), lambda x: ~x.rlike(RULE_LINE))
    return F.transform(lines, table_cells_of)


def markdown_table(rows) -> Column:
    """Rows of cells as a markdown table; the first row is its header."""
    lines = F.transform(S._c(rows), markdown_row)
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size(F.get(S._c(rows), F.lit(0)))))
    return F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1)))), "\n")


def render_tables(rows: DataFrame, mode: str = "html", key: str = "doc_id") -> DataFrame:
    """One table per page as HTML (the default) or markdown, with its shape."""
    if mode not in TABLE_OUTPUT_MODES:
        raise ValueError(f"unknown table output mode {mode!r}")
    line = html_row("cells") if mode == "html" else markdown_row("cells")
    lines = F.array_sort(F.collect_list(F.struct("row_no", line.alias("line"))))
    grouped = rows.groupBy(key, "page_number").agg(
        lines.alias("_lines"), F.count(F.lit(1)).alias("n_rows"), F.max(F.size("cells")).cast("bigint").alias("n_cols")
    )
    joined = F.transform("_lines", lambda x: x["line"])
    if mode == "html":
        body = F.array_join(joined, "")
        content = F.concat(F.lit("<table>"), body, F.lit("</table>"))
    else:
        rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.col("n_cols").cast("int")))
        content = F.array_join(F.concat(F.slice(joined, 1, 1), F.array(rule), F.slice(joined, 2, F.size(joined))), "\n")
    return grouped.select(key, "page_number", "n_rows", "n_cols", content.alias("content"))


def table_cells(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Flat cell list with row and column numbers."""
    return rows.select(key, "page_number", "row_no", F.posexplode("cells").alias("col_no", "cell"))


def _islands(tables: DataFrame, key: str, **limits: int) -> DataFrame:
    """Runs of consecutive pages whose tables have equal column counts.

    Page number minus position is constant along such a run.
    """
    n = hotkeys.numbered(tables, [key, "n_cols"], "page_number", "_pos", **limits)
    return n.withColumn("_island", F.col("page_number") - F.col("_pos")).drop("_pos")


def merge_tables(tables: DataFrame, key: str = "doc_id", **limits: int) -> DataFrame:
    """Merged tables: id, pages, target columns.  Single-page tables are not merged.

    ``tables`` has one row per page: ``(key, page_number, n_rows, n_cols)``.
    """
    merged = (
        _islands(tables, key, **limits)
        .groupBy(key, "n_cols", "_island")
        .agg(
            F.min("page_number").alias("start_page"),
            F.max("page_number").alias("end_page"),
            F.count(F.lit(1)).alias("pages_merged"),
            F.sum("n_rows").alias("n_rows"),
        )
        .where(F.col("pages_merged") > 1)
    )
    return merged.select(
        key,
        merged_id(key, F.col("start_page")).alias("merged_table_id"),
        "start_page",
        "end_page",
        "pages_merged",
        "n_rows",
        F.col("n_cols").alias("target_columns"),
    )


def merged_id(key: str, start_page: Column) -> Column:
    return F.concat_ws("_", F.lit("merged"), F.col(key).cast("string"), start_page.cast("string"))


def merged_table_html(
    tables: DataFrame, key: str = "doc_id", part_pages: int = PART_PAGES, **limits: int
) -> DataFrame:
    """HTML of merged tables; ``tables`` also has the page tables' ``content``.

    A table of more than ``part_pages`` pages comes in numbered parts, to be
    concatenated in order; so no value grows with the length of a table.
    """
    runs = _islands(tables, key, **limits).withColumn("_inner", F.expr("substring(content, 8, length(content) - 15)"))
    summary = runs.groupBy(key, "n_cols", "_island").agg(
        F.min("page_number").alias("start_page"), F.count(F.lit(1)).alias("pages_merged")
    )
    # Same run, same (key, n_cols, island): cut it at fixed page numbers.
    cut = runs.withColumn("part_no", F.expr(f"page_number div {part_pages}"))
    parts = cut.groupBy(key, "n_cols", "_island", "part_no").agg(
        F.array_sort(F.collect_list(F.struct("page_number", "_inner"))).alias("_rows"),
    )
    body = F.array_join(F.transform("_rows", lambda r: r["_inner"]), "")
    last = F.col("start_page") + F.col("pages_merged") - 1
    first_part = F.col("part_no") == F.expr(f"start_page div {part_pages}")
    last_part = F.col("part_no") == F.floor(last / part_pages)
    html = F.concat(
        F.when(first_part, "<table>").otherwise(""), body, F.when(last_part, "</table>").otherwise("")
    )
    return (
        parts.join(summary.where(F.col("pages_merged") > 1), [key, "n_cols", "_island"])
        .select(
            key,
            merged_id(key, F.col("start_page")).alias("merged_table_id"),
            "part_no",
            html.alias("merged_table_html"),
        )
    )


def table_summary(cells_first_row: Column, n_rows: Column, n_cols: Column) -> Column:
    """Deterministic table summary: shape and first row."""
    return F.concat(
        n_rows.cast("string"), F.lit(" rows, "), n_cols.cast("string"), F.lit(" columns; first row: "),
        F.array_join(cells_first_row, ", "),
    )


def figure_summary(caption: Column) -> Column:
    """Deterministic figure summary: the first sentence of its caption."""
    return S.trimmed(F.regexp_extract(caption, r"^([^.!?]*[.!?]?)", 1))


def summarize_tables(
    rows: DataFrame, enabled: bool = False, hook: Callable[[Column], Column] | None = None, key: str = "doc_id"
) -> DataFrame:
    """Summary per table; NULL unless enabled.  A hook gets the markdown instead."""
    grouped = rows.groupBy(key, "page_number").agg(
        F.min_by("cells", "row_no").alias("_first"),
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.size("cells")).cast("bigint").alias("n_cols"),
    )
    if not enabled:
        return grouped.select(key, "page_number", F.lit(None).cast("string").alias("summary"))
    if hook is None:
        text = table_summary(F.col("_first"), F.col("n_rows"), F.col("n_cols"))
        return grouped.select(key, "page_number", text.alias("summary"))
    return render_tables(rows, "markdown", key).select(key, "page_number", hook(F.col("content")).alias("summary"))


def summarize_figures(
    frags: DataFrame, enabled: bool = False, hook: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Figure fragments with a summary; NULL unless enabled."""
    figures = frags.where(F.col("fragment_type").isin("figure", "figure_caption", "chart"))
    if not enabled:
        return figures.withColumn("summary", F.lit(None).cast("string"))
    return figures.withColumn("summary", hook(F.col("text")) if hook else figure_summary(F.col("text")))
