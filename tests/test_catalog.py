import datetime as dt

import pytest
from pyspark.sql import functions as F

from docspark.operators import catalog as C
from docspark.operators import hotkeys


@pytest.fixture(scope="module")
def files(spark):
    # Many equal timestamps, so the id has to break ties.
    base = dt.datetime(2024, 1, 1)
    rows = [(i, f"f{i}.txt", base + dt.timedelta(minutes=i // 7)) for i in range(60)]
    return spark.createDataFrame(rows, "id bigint, file_name string, created_at timestamp").cache()


def test_pages_cover_everything_once(files):
    pages = list(C.iter_pages(files, limit=13))
    ids = [r["id"] for p in pages for r in p]
    assert ids == sorted(range(60), reverse=True)
    assert [len(p) for p in pages] == [13, 13, 13, 13, 8]
    assert [p[0]["has_more"] for p in pages] == [True] * 4 + [False]
    assert pages[0][0]["prev_cursor"] is None and pages[-1][0]["next_cursor"] is None


def test_prev_page_goes_back(files):
    first = C.keyset_page(files, None, "next", 10).collect()
    second = C.keyset_page(files, first[0]["next_cursor"], "next", 10).collect()
    back = C.keyset_page(files, second[0]["prev_cursor"], "prev", 10).collect()
    assert [r["id"] for r in back] == [r["id"] for r in first]
    assert not back[0]["has_more"]


def test_exact_last_page_and_empty(files):
    assert [len(p) for p in C.iter_pages(files, limit=20)] == [20, 20, 20]
    assert list(C.iter_pages(files.where("id < 0"), limit=20)) == []


def test_iter_rows(files):
    assert {r["id"] for r in C.iter_rows(files)} == set(range(60))


def test_bounds_are_exclusive_and_names_case_sensitive(files):
    got = C.list_files(files, created_after="2024-01-01 00:01:00", created_before="2024-01-01 00:03:00")
    assert {r["id"] for r in got.collect()} == set(range(14, 21))
    assert C.list_files(files, file_name="F1").count() == 0
    assert C.list_files(files, file_name="f1").count() == 11
    assert C.list_files(files, file_name="").count() == 60


def test_page_index_hot(files):
    o = hotkeys.paired_order(files, F.unix_seconds("created_at"), F.col("id"), "o")
    for limits in ({}, {"min_rows": 4}):
        got = {r["id"]: (r["row_no"], r["page_no"]) for r in C.page_index(o, 25, "o", **limits).collect()}
        assert got[59] == (1, 1) and got[35] == (25, 1) and got[34] == (26, 2) and got[0] == (60, 3)


def test_create_datasets(spark):
    day = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([(1, "a")], "dataset_id bigint, name string")
    new = spark.createDataFrame(
        [(2, "a", day), (3, "b", day), (4, "b", day + dt.timedelta(1)), (5, "bad name", day), (6, "c", day)],
        "dataset_id bigint, name string, created_at timestamp",
    )
    out, rejects = C.create_datasets(old, new)
    assert {(r["dataset_id"], r["name"]) for r in out.collect()} == {(1, "a"), (3, "b"), (6, "c")}
    assert sorted((r["name"], r["code"]) for r in rejects.collect()) == [
        ("a", "ENTITY_ALREADY_EXISTS"), ("b", "ENTITY_ALREADY_EXISTS"), ("bad name", "INVALID_DATASET_NAME"),
    ]


def test_update_replaces_whole_objects_but_not_the_name(spark):
    old = spark.sql("select 1L as dataset_id, 'n' as name, named_struct('a', 1, 'b', 2) as options, 'x' as description")
    patch = spark.sql("select 1L as dataset_id, 'other' as name, named_struct('a', 9, 'b', cast(null as int)) as options, cast(null as string) as description")
    r = C.update_datasets(old, patch).first()
    assert (r["name"], r["options"]["a"], r["options"]["b"], r["description"]) == ("n", 9, None, "x")


def test_deletes_do_not_cascade(spark):
    files = spark.createDataFrame([(1,), (2,)], "file_id int")
    jobs = spark.createDataFrame([(10, 1), (11, 2)], "parse_id int, file_id int")
    gone = spark.createDataFrame([(1,)], "file_id int")
    assert [r["file_id"] for r in C.apply_deletes(files, gone, "file_id").collect()] == [2]
    assert jobs.count() == 2


def test_directory_listing(spark):
    rows = [("b.txt", False), ("zdir", True), ("a.txt", False), ("adir", True)]
    got = C.directory_listing(spark.createDataFrame(rows, "name string, is_dir boolean")).collect()
    assert [r["name"] for r in got] == ["adir", "zdir", "a.txt", "b.txt"]


def test_lookups(spark, files):
    assert C.get_by_id(files, "id", 7).first()["file_name"] == "f7.txt"
    assert "file_name" not in C.get_by_id(files, "id", 7, "file_name").columns
    found, missing = C.get_many(spark.createDataFrame([(7,), (99,)], "id bigint"), files, "id")
    assert [r["id"] for r in found.collect()] == [7]
    assert [(r["id"], r["code"]) for r in missing.collect()] == [("99", "ENTITY_NOT_FOUND")]


def test_options_and_analytics_on_request(spark):
    r = spark.createDataFrame([(1, "x")], "parse_id int, options string")
    assert C.project_options(r).columns == ["parse_id"]
    assert C.project_options(r, True).columns == ["parse_id", "options"]
