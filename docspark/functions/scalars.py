"""Scalar rules as Column expressions; all run JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats that must be the same for every caller.
DATASET_NAME_PATTERN = r"^[A-Za-z0-9_-]+$"
FILE_ID_PREFIX = "file_"
INT_PATTERN = r"^-?(0|[1-9][0-9]*)$"
INT_ARRAY_PATTERN = r"^\[[ \t\r\n]*(-?(0|[1-9][0-9]*)[ \t\r\n]*(,[ \t\r\n]*-?(0|[1-9][0-9]*)[ \t\r\n]*)*)?\]$"
PAGE_RANGE_PATTERN = r"^ *[0-9]{1,9} *(- *[0-9]{1,9} *)?(, *[0-9]{1,9} *(- *[0-9]{1,9} *)?)*$"
RFC3339_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
)
BLANKS = " \t\r\n\x0b\x0c"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body) -> Column:
    """Bind an expression to a lambda variable, so that ``body`` may use it
    many times (also inside lambdas) while it is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sum(values: Column) -> Column:
    """Inclusive running totals of an array, by doubling steps: no array is grown element by element."""
    rounds = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")

    def step(acc: Column, k: Column) -> Column:
        back = F.pow(F.lit(2), k).cast("int")
        return F.transform(acc, lambda x, i: x + F.when(i >= back, F.get(acc, i - back)).otherwise(0))

    return F.aggregate(F.filter(F.sequence(F.lit(0), rounds), lambda k: k < rounds), values, step)


def unnest(df: DataFrame, keep: list, array, alias: str) -> DataFrame:
    """Explode an array column.

    The outer form with a NULL filter behind it, because the optimizer guards a
    plain explode with a size filter in front, and that filter would compute an
    expensive array a second time.
    """
    return df.select(*keep, F.explode_outer(array).alias(alias)).where(F.col(alias).isNotNull())


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add an expensive column that is computed once even if it is filtered on.

    A filter on a projected column is pushed below the projection together with
    the expression, which would then run twice; it is not pushed below explode.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def blank_to_null(col) -> Column:
    """An omitted string field arrives as ``""``; treat it as NULL."""
    return F.nullif(_c(col), F.lit(""))


def trimmed(col) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.btrim(_c(col), F.lit(BLANKS))


def source_provided(file_id, file_url, raw_text) -> Column:
    """True iff exactly one of the three document sources is non-empty."""
    given = [F.coalesce(_c(c) != "", F.lit(False)).cast("int") for c in (file_id, file_url, raw_text)]
    return (given[0] + given[1] + given[2]) == 1


def union_values_valid(col) -> Column:
    """True for a JSON integer, a JSON array of integers, JSON null or NULL."""
    t = trimmed(col)
    return t.isNull() | (t == "null") | t.rlike(INT_PATTERN) | t.rlike(INT_ARRAY_PATTERN)


def union_values(col) -> Column:
    """One-or-many JSON integers as an array; NULL when the text is neither."""
    t = trimmed(col)
    as_array = (
        F.when(t.rlike(INT_PATTERN), F.concat(F.lit("["), t, F.lit("]")))
        .when(t.rlike(INT_ARRAY_PATTERN), t)
    )
    return F.from_json(as_array, "array<bigint>")


def union_values_json(col) -> Column:
    """One-or-many values are always written back as an array."""
    return F.to_json(_c(col))


def page_range_valid(col) -> Column:
    """True when the text is a list of page numbers and ascending 1-based ranges."""
    t = _c(col)
    well_formed = t.rlike(PAGE_RANGE_PATTERN)
    ok = F.forall(page_ranges(t), lambda r: (r["lo"] >= 1) & (r["lo"] <= r["hi"]))
    return F.when(well_formed, ok).otherwise(F.lit(False))


def page_ranges(col) -> Column:
    """``"1-5,8"`` as ``[{lo:1,hi:5},{lo:8,hi:8}]``; never expanded, so never large."""
    t = F.when(_c(col).rlike(PAGE_RANGE_PATTERN), F.regexp_replace(_c(col), " ", ""))

    def bounds(part: Column) -> Column:
        ends = F.split(part, "-")
        return F.struct(
            F.element_at(ends, 1).cast("int").alias("lo"),
            F.element_at(ends, -1).cast("int").alias("hi"),
        )

    return F.transform(F.split(t, ","), bounds)


def page_range(col, total_pages) -> Column:
    """Sorted distinct page numbers, clipped to the document; NULL when invalid."""
    total = _c(total_pages).cast("int")

    def expand(r: Column) -> Column:
        hi = F.least(r["hi"], total)
        return F.when(r["lo"] <= hi, F.sequence(r["lo"], hi)).otherwise(F.array().cast("array<int>"))

    pages = F.array_sort(F.array_distinct(F.flatten(F.transform(page_ranges(col), expand))))
    return F.when(page_range_valid(col), pages)


def in_page_range(page, range_text) -> Column:
    """Page membership without expanding the range; no range means every page."""
    rng, number = _c(range_text), _c(page)
    hit = F.exists(page_ranges(rng), lambda r: (number >= r["lo"]) & (number <= r["hi"]))
    return F.when(rng.isNull() | (rng == ""), F.lit(True)).otherwise(page_range_valid(rng) & hit)


def ts_rfc3339(col) -> Column:
    """RFC 3339 text to a timestamp; NULL for anything else."""
    return F.try_to_timestamp(F.when(_c(col).rlike(RFC3339_PATTERN), _c(col)))


def ts_millis(col) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(_c(col).cast("bigint"))


def valid_dataset_name(col) -> Column:
    return F.coalesce(_c(col).rlike(DATASET_NAME_PATTERN), F.lit(False))


def id_version(col) -> Column:
    """Generation of a file id: the current prefix is v2, any other id is v1."""
    c = _c(col)
    return F.when(c.startswith(FILE_ID_PREFIX), F.lit("v2")).when(c != "", F.lit("v1"))


def strip_scheme(col) -> Column:
    """Remove ``http(s)://`` when something follows it."""
    return F.regexp_replace(_c(col), r"^https?://((?s:.+))$", "$1")


def b64_encode(col) -> Column:
    return F.base64(F.encode(_c(col), "UTF-8"))


def b64_decode(col) -> Column:
    return F.decode(F.unbase64(_c(col)), "UTF-8")


def error_text(message, code) -> Column:
    """Error rendering with and without a code."""
    m, k = _c(message), _c(code)
    with_code = F.concat(F.lit("sandbox error: "), m, F.lit(" (code: "), k, F.lit(")"))
    return F.when(F.coalesce(k, F.lit("")) != "", with_code).otherwise(F.concat(F.lit("sandbox error: "), m))


def api_error_text(code, message, trace_id, details) -> Column:
    """Error-response rendering with all four fields."""
    none = F.lit("<nil>")
    return F.concat(
        F.lit("code: "), F.coalesce(_c(code), F.lit("")),
        F.lit(", message: "), F.coalesce(_c(message), F.lit("")),
        F.lit(", trace_id: "), F.coalesce(_c(trace_id), F.lit("")),
        F.lit(", details: "), F.coalesce(_c(details), none),
    )


def peek(col, n: int = 100) -> Column:
    """Short preview of a long text, by characters."""
    return F.substring(_c(col), 1, n)


def label_map(**labels) -> Column:
    """Label map from columns; values are text, NULL values are left out."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), _c(v).cast("string").alias("value")) for k, v in labels.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def labels_json(col) -> Column:
    return F.to_json(_c(col))


def labels_from_json(col) -> Column:
    return F.from_json(_c(col), "map<string,string>")


def label_equals(labels, key: str, value: str) -> Column:
    return F.coalesce(F.try_element_at(_c(labels), F.lit(key)) == value, F.lit(False))
