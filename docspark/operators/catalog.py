"""Listings, lookups, paging and catalog updates."""

from __future__ import annotations

import base64
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from docspark.functions import scalars as S
from docspark.operators import hotkeys


# ---- filters -------------------------------------------------------------

def _narrow(df: DataFrame, conditions: list[Column | None]) -> DataFrame:
    for condition in conditions:
        if condition is not None:
            df = df.where(condition)
    return df


def _when_given(value, make) -> Column | None:
    return None if value is None or value == "" else make(value)


def _time(df: DataFrame, column: str, value) -> Column:
    """The bound in the column's own type, so that the comparison reaches the scan."""
    return F.lit(value).cast(df.schema[column].dataType)


def list_files(files: DataFrame, file_name=None, created_after=None, created_before=None) -> DataFrame:
    """Case-sensitive name part and exclusive time bounds; absent filters are ignored."""
    return _narrow(files, [
        _when_given(file_name, lambda v: F.col("file_name").contains(v)),
        _when_given(created_after, lambda v: F.col("created_at") > _time(files, "created_at", v)),
        _when_given(created_before, lambda v: F.col("created_at") < _time(files, "created_at", v)),
    ])


def list_jobs(
    jobs: DataFrame,
    datasets: DataFrame | None = None,
    dataset_name=None,
    file_name=None,
    parse_id=None,
    status=None,
    created_after=None,
    created_before=None,
    finished_after=None,
    finished_before=None,
) -> DataFrame:
    """Job listing filter; a dataset *name* is resolved by a semi join."""
    out = _narrow(jobs, [
        _when_given(file_name, lambda v: F.col("file_name") == v),
        _when_given(parse_id, lambda v: F.col("parse_id") == v),
        _when_given(status, lambda v: F.col("status") == v),
        _when_given(created_after, lambda v: F.col("created_at") > _time(jobs, "created_at", v)),
        _when_given(created_before, lambda v: F.col("created_at") < _time(jobs, "created_at", v)),
        _when_given(finished_after, lambda v: F.col("finished_at") > _time(jobs, "finished_at", v)),
        _when_given(finished_before, lambda v: F.col("finished_at") < _time(jobs, "finished_at", v)),
    ])
    if dataset_name:
        wanted = datasets.where(F.col("name") == dataset_name).select("dataset_id")
        out = out.join(wanted, "dataset_id", "left_semi")
    return out


def list_dataset_data(jobs: DataFrame, dataset_id, **filters) -> DataFrame:
    """Jobs of one dataset; the other job filters apply too."""
    return list_jobs(jobs.where(F.col("dataset_id") == dataset_id), **filters)


def list_datasets(datasets: DataFrame, status=None, name=None) -> DataFrame:
    return _narrow(datasets, [
        _when_given(status, lambda v: F.col("status") == v),
        _when_given(name, lambda v: F.col("name").contains(v)),
    ])


def has_label(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.where(S.label_equals("labels", key, value))


def get_by_id(df: DataFrame, key: str, value, *heavy: str) -> DataFrame:
    """Point lookup; the equality reaches the parquet scan.  ``heavy`` columns are left out."""
    return df.where(F.col(key) == value).drop(*heavy)


def get_many(ids: DataFrame, df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Look up many ids: the found rows, and ``ENTITY_NOT_FOUND`` rejects."""
    found = df.join(ids.select(key).distinct(), key, "left_semi")
    missing = ids.join(df.select(key), key, "left_anti").select(
        F.col(key).cast("string").alias("id"), F.lit("ENTITY_NOT_FOUND").alias("code")
    )
    return found, missing


def project_options(results: DataFrame, with_options: bool = False) -> DataFrame:
    """Options are heavy and only read on request."""
    return results if with_options else results.drop("options")


def project_analytics(datasets: DataFrame, analytics: DataFrame | None = None) -> DataFrame:
    """Dataset rows; analytics are computed and joined only when they are given."""
    return datasets if analytics is None else datasets.join(analytics, "dataset_id", "left")


def normalize_requests(requests: DataFrame) -> DataFrame:
    """Blank sources become NULL; a file name only means something next to a file id."""
    out = requests
    for c in ("file_id", "file_url", "raw_text"):
        out = out.withColumn(c, S.blank_to_null(c))
    return out.withColumn("file_name", F.when(F.col("file_id").isNotNull(), F.col("file_name")))


# ---- membership ----------------------------------------------------------

def present(ids: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    return ids.join(listed.select(key), key, "left_semi")


def apply_deletes(df: DataFrame, tombstones: DataFrame, key: str) -> DataFrame:
    """Rows that were not deleted.  Never cascades: only this table is touched."""
    return df.join(tombstones.select(key), key, "left_anti")


# ---- dataset create / update --------------------------------------------

def create_datasets(existing: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add datasets with unused, well-formed names; the rest are rejects.

    Of several new datasets with one name, the first created wins.
    """
    shaped = new.withColumn("valid", S.valid_dataset_name("name"))
    bad_name = shaped.where(~F.col("valid")).select("name", F.lit("INVALID_DATASET_NAME").alias("code"))
    valid = shaped.where("valid").drop("valid")
    row = F.struct(*[F.col(c) for c in valid.columns])
    firsts = valid.groupBy(F.col("name").alias("_name")).agg(
        F.min_by(row, F.struct("created_at", "dataset_id")).alias("_row")
    )
    taken = existing.select(F.col("name").alias("_name"))
    created = firsts.join(taken, "_name", "left_anti").select("_row.*")
    # By id, not by name: a name may have many losers, an id has one row.
    clashes = valid.join(created.select("dataset_id"), "dataset_id", "left_anti").select(
        "name", F.lit("ENTITY_ALREADY_EXISTS").alias("code")
    )
    return existing.unionByName(created, allowMissingColumns=True), bad_name.unionByName(clashes)


def update_datasets(existing: DataFrame, patch: DataFrame, key: str = "dataset_id", at: str | None = None) -> DataFrame:
    """Replace each supplied object whole; omitted ones and the name stay.

    Of several patches of one id the last by ``at`` counts (without ``at``, or at
    the same time, the largest by value).
    """
    changed = [c for c in patch.columns if c not in (key, "name", at)]
    order = F.struct(*[F.to_json(F.struct(F.col(c))).alias(f"_{i}") for i, c in enumerate(changed)])
    p = patch.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(c).alias(f"_new_{c}") for c in changed]), F.struct(F.col(at) if at else F.lit(0), order)).alias("_p")
    ).select(key, "_p.*")
    joined = existing.join(p, key, "left")
    return joined.select(*[
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in changed else F.col(c)
        for c in existing.columns
    ])


# ---- ordering and paging -------------------------------------------------

def cursor_of(created_at, row_id) -> Column:
    """Opaque paging cursor: base64 of the timestamp and the tie-breaking id."""
    ts = F.date_format(S._c(created_at).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return S.b64_encode(F.concat(ts, F.lit("|"), S._c(row_id).cast("string")))


def keyset_page(
    df: DataFrame,
    cursor: str | None = None,
    direction: str = "next",
    limit: int = 100,
    ts: str = "created_at",
    key: str = "id",
) -> DataFrame:
    """One page, newest first, with ``has_more`` and the two cursors on each row.

    ``limit + 1`` rows are taken with a top-k, so no full sort happens and the
    window below runs over those few rows only.
    """
    forward = direction == "next"
    if cursor:
        # Decoded here, so that the bound is a constant the scan can use.
        moment, ident_text = base64.b64decode(cursor).decode().split("|", 1)
        at = F.lit(moment).cast("timestamp").cast(df.schema[ts].dataType)
        at_id = F.lit(ident_text).cast(df.schema[key].dataType)
        stamp, ident = F.col(ts), F.col(key)
        if forward:
            df = df.where((stamp <= at) & ((stamp < at) | (ident < at_id)))
        else:
            df = df.where((stamp >= at) & ((stamp > at) | (ident > at_id)))
    order = [F.col(ts).desc(), F.col(key).desc()] if forward else [F.col(ts).asc(), F.col(key).asc()]
    taken = df.orderBy(*order).limit(limit + 1)
    pos = Window.partitionBy(F.lit(0)).orderBy(*order)
    whole = Window.partitionBy(F.lit(0))
    page = (
        taken.withColumn("_pos", F.row_number().over(pos))
        .withColumn("has_more", F.count(F.lit(1)).over(whole) > limit)
        .where(F.col("_pos") <= limit)
    )
    mine = cursor_of(ts, key)
    by_time = F.struct(F.col(ts), F.col(key))
    oldest = F.min_by(mine, by_time).over(whole)
    newest = F.max_by(mine, by_time).over(whole)
    more_older = F.col("has_more") if forward else F.lit(True)
    more_newer = F.lit(bool(cursor)) if forward else F.col("has_more")
    return (
        page.withColumn("next_cursor", F.when(more_older, oldest))
        .withColumn("prev_cursor", F.when(more_newer, newest))
        .drop("_pos")
        .orderBy(F.col(ts).desc(), F.col(key).desc())
    )


def iter_pages(df: DataFrame, limit: int = 100, ts: str = "created_at", key: str = "id") -> Iterator[list[Row]]:
    """Pull page after page for a driver-side consumer; stops on a missing cursor."""
    cursor = None
    while True:
        rows = keyset_page(df, cursor, "next", limit, ts, key).collect()
        if rows:
            yield rows
        if not rows or not rows[0]["has_more"] or not rows[0]["next_cursor"]:
            return
        cursor = rows[0]["next_cursor"]


def iter_rows(df: DataFrame) -> Iterator[Row]:
    """Every row, lazily, one partition at a time, for a driver-side consumer."""
    return df.toLocalIterator(prefetchPartitions=True)


def page_index(df: DataFrame, size: int, order: str, ties=(), **limits: int) -> DataFrame:
    """Page number of every row in one global order (``order`` is an integer, descending).

    The order is cut into blocks, so no task ever holds the whole table.
    """
    d = df.withColumn("_all", F.lit(0)).withColumn("_key", -F.col(order))
    n = hotkeys.numbered(d, ["_all"], "_key", "row_no", ties, **limits)
    return n.withColumn("page_no", F.ceil(F.col("row_no") / size).cast("bigint")).drop("_all", "_key")


def all_pages(df: DataFrame, size: int, ts: str = "created_at", key: str = "id", **limits: int) -> DataFrame:
    """Every page of a listing at once, newest first: each row with its page number and the cursor that leads to the next page.

    The distributed form of following the cursors to the end; the last page has
    no next cursor.  ``ts`` is a date or timestamp, ``key`` an integer.
    """
    day = F.unix_micros(F.col(ts).cast("timestamp"))
    ordered = hotkeys.paired_order(df, day, F.col(key), "_order")
    pages = page_index(ordered, size, "_order", [F.col(ts).desc(), F.col(key).desc()], **limits)
    # The last row of a page is its cursor, if another page begins.
    ends = pages.where(F.col("row_no") % size == 0).select(F.col("page_no").alias("_p"), cursor_of(ts, key).alias("next_cursor"))
    begins = pages.where(((F.col("row_no") - 1) % size == 0) & (F.col("row_no") > 1)).select((F.col("page_no") - 1).alias("_p"))
    ends = ends.join(begins, "_p", "left_semi")
    return pages.join(ends, pages["page_no"] == ends["_p"], "left").drop("_p", "_order", "row_no")


def directory_listing(entries: DataFrame, *parent: str) -> DataFrame:
    """Directories first, then by name; a range-partitioned sort."""
    return entries.orderBy(*parent, F.col("is_dir").desc(), F.col("name"))


def listing_positions(entries: DataFrame, *parent: str) -> DataFrame:
    """The same with each entry's position in its directory, for consumers that lose the order of rows.

    Directories are bounded by what one folder holds; entries of equal name are
    numbered in an arbitrary order.
    """
    w = Window.partitionBy(*parent).orderBy(F.col("is_dir").desc(), F.col("name"))
    return entries.withColumn("position", F.row_number().over(w))
