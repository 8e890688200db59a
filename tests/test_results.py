"""Decoding of stored results: names, nested values, NULL against zero."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from docspark.sources import files as files_src
from docspark.sources import results as R
from docspark.workload import q_sources, tables

RESULT = {
    "parse_id": "parse_1", "parsed_pages_count": 3, "status": "successful", "created_at": "2024-01-01T00:00:00Z",
    "finished_at": "2024-01-01T00:01:00Z", "error": "", "labels": {"team": "a"}, "total_pages": 3,
    "tasks_completed_count": 0, "dataset_id": "",
    "chunks": [{"content": "c", "page_number": 1}],
    "pages": [{
        "page_number": 1, "dimensions": [600, 800], "page_dimensions": {"width": 600, "height": 800},
        "classification_reason": "why",
        "page_fragments": [
            {"fragment_type": "title", "reading_order": 0, "bbox": {"x1": 1.5}, "content": {"header": {"content": "T", "level": 0}}},
            {"fragment_type": "table", "reading_order": 1, "content": {"table": {"content": "x", "cells": [{"text": "a", "bounding_box": {"x1": 0.0}}], "html": "<table/>"}}},
        ],
    }],
    "page_classes": [{"page_class": "k", "page_numbers": [1, 2], "classification_reasons": {"1": "r1", "2": "r2"}}],
    "structured_data": [
        {"data": {"a": 1}, "page_numbers": 1, "schema_name": "s"},
        {"data": {"a": 2}, "page_numbers": [1, 2, 3], "schema_name": "s"},
    ],
    "merged_tables": [{
        "merged_table_id": "m", "merged_table_html": "<table/>", "start_page": 1, "end_page": 3, "pages_merged": 3,
        "merge_actions": {"pages": [1, 2, 3], "target_columns": 5},
    }],
    "options": {"file_id": "file_1", "file_name": "f", "configuration": {"parsing_options": {"chunking_strategy": "page", "merge_tables": True}}},
    "usage": {
        "pages_parsed": 5, "signature_detected_pages": 1, "strikethrough_detected_pages": 0, "ocr_input_tokens_used": 100,
        "ocr_output_tokens_used": 200, "extraction_input_tokens_used": 300, "extraction_output_tokens_used": 400,
        "summarization_input_tokens_used": 50, "summarization_output_tokens_used": 60,
    },
}


@pytest.fixture
def decoded(spark):
    df = spark.createDataFrame([(json.dumps(RESULT),), ("{broken",), ('{"parse_id":"p2","status":"pending"}',)], "j string")
    return {r["parse_id"]: r for r in R.decode_results(df, "j").collect()}


def test_golden(decoded):
    r = decoded["parse_1"]
    assert tuple(r["usage"]) == (5, 1, 0, 100, 200, 300, 400, 50, 60)
    assert [s["page_numbers"] for s in r["structured_data"]] == [[1], [1, 2, 3]]
    assert json.loads(r["structured_data"][1]["data"]) == {"a": 2}
    assert r["page_classes"][0]["classification_reasons"] == {1: "r1", 2: "r2"}
    m = r["merged_tables"][0]
    assert (m["start_page"], m["end_page"], m["pages_merged"], m["merge_actions"]["target_columns"]) == (1, 3, 3, 5)
    first, second = r["pages"][0]["page_fragments"]
    assert first["content"]["header"]["content"] == "T" and first["content"]["table"] is None
    assert second["content"]["table"]["cells"][0]["text"] == "a" and second["bbox"] is None
    assert r["options"]["configuration"]["parsing_options"]["merge_tables"] is True


def test_null_is_not_zero(decoded):
    r = decoded["parse_1"]
    assert r["tasks_completed_count"] == 0 and r["tasks_total_count"] is None
    assert r["error"] is None and r["dataset_id"] is None
    p2 = decoded["p2"]
    assert p2["usage"] is None and p2["pages"] is None and p2["created_at"] is None
    assert None in decoded


def test_lines_that_are_no_results_are_rejects(spark, tmp_path):
    good, wrong = json.dumps(RESULT), json.dumps({**RESULT, "total_pages": "many"})
    deep = json.dumps({**RESULT, "pages": [{"page_number": "one"}]})
    broken = [good[:-4], "oops", wrong, deep, "[1]", "5", "null"]
    df = spark.createDataFrame([(x,) for x in [good, "{}", *broken, "", None]], "j string")
    ok, bad = R.decode_with_rejects(df, "j")
    assert sorted(str(r["parse_id"]) for r in ok.collect()) == ["None", "parse_1"]
    assert sorted(str(r["line"]) for r in bad.collect()) == sorted([*broken, "", "None"])
    # A count that needs no field gives the same.
    assert (ok.count(), bad.count()) == (2, 9)
    (tmp_path / "r.jsonl").write_text("\n".join([good, "", *broken]) + "\n")
    ok, bad = R.read_results_with_rejects(spark, str(tmp_path))
    assert [r["parse_id"] for r in ok.collect()] == ["parse_1"] and sorted(r["line"] for r in bad.collect()) == sorted(broken)


def test_files_and_replies(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text(json.dumps(RESULT) + "\n")
    assert R.read_results(spark, str(tmp_path)).first()["parse_id"] == "parse_1"
    feed = ["event: parse_queued", "data: {}", "", "event: parse_done", "data: " + json.dumps(RESULT), ""]
    plain = json.dumps({"parse_id": "p3", "status": "pending"}, indent=1).split("\n")
    rows = [(1, "text/event-stream", i, x) for i, x in enumerate(feed)] + [(2, "application/json", i, x) for i, x in enumerate(plain)]
    df = spark.createDataFrame(rows, "stream_id bigint, content_type string, line_no bigint, line string")
    assert {r["stream_id"]: r["parse_id"] for r in R.read_replies(df).collect()} == {1: "parse_1", 2: "p3"}


def test_every_reply_is_one_row(spark):
    done = ["event: parse_done", 'data: {"parse_id":"a"}', ""]
    feeds = {
        1: ["event: parse_failed", 'data: {"error":"x"}', "", *done],
        2: [*done, "event: parse_done", 'data: {"parse_id":"b"}', ""],
        3: ["event: parse_queued", "data: {}", ""],
        4: ["no colon", *done],
        5: [": only a comment"],
        6: ["event: parse_done", "data: 5", ""],
    }
    rows = [(k, "text/event-stream", i, x) for k, lines in feeds.items() for i, x in enumerate(lines)] + [(7, None, 0, "oops")]
    df = spark.createDataFrame(rows, "stream_id bigint, content_type string, line_no bigint, line string")
    got = {r["stream_id"]: (r["parse_id"], r["reply_status"], r["reply_error"]) for r in R.read_replies(df).collect()}
    assert got == {
        1: (None, "failure", "failed to parse result: x"), 2: ("a", "successful", None),
        3: (None, "error", 'SSE stream ended after 1 event(s), last event "parse_queued", without a terminal event (parse_done or parse_failed)'),
        4: (None, "error", 'failed to scan SSE events: malformed line in SSE stream: "no colon"'),
        5: (None, "error", "SSE stream closed without sending any events"), 6: (None, "error", "failed to unmarshal SSE event"),
        7: (None, "error", "failed to decode SSE response"),
    }


def test_write_is_partitioned(spark, tmp_path):
    df = spark.createDataFrame([(1, "read"), (2, "extract")], "parse_id int, job_type string")
    R.write_results(df, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["job_type=extract", "job_type=read"]


def test_ingest(spark, tmp_path):
    (tmp_path / "a.TXT").write_bytes(b"hello")
    (tmp_path / "copy.md").write_bytes(b"hello")
    (tmp_path / "blob").write_bytes(b"x" * 100)
    got = {r["file_name"]: r for r in files_src.ingest_files(spark, str(tmp_path), {"k": "v"})[0].collect()}
    assert got["a.TXT"]["file_id"] == got["copy.md"]["file_id"] == "file_" + got["a.TXT"]["checksum_sha256"]
    assert (got["a.TXT"]["mime_type"], got["copy.md"]["mime_type"], got["blob"]["mime_type"]) == (
        "text/plain", "text/markdown", "application/octet-stream")
    assert got["a.TXT"]["file_size"] == 5 and got["a.TXT"]["labels"] == {"k": "v"}
    files, rejects = files_src.ingest_files(spark, str(tmp_path), limit=50)
    assert files.count() == 2
    assert [tuple(r)[:2] + (r["code"],) for r in rejects.collect()] == [("blob", 100, "INVALID_FILE")]


def test_dedup_keeps_the_earliest_name(spark):
    df = spark.sql("""select * from values ('f1', 'late', timestamp'2024-01-02'), ('f1', 'early', timestamp'2024-01-01'),
        ('f2', 'x', timestamp'2024-01-01') as t(file_id, file_name, created_at)""")
    got = {r["file_id"]: (r["file_name"], r["copies"]) for r in files_src.dedup_files(df).collect()}
    assert got == {"f1": ("early", 2), "f2": ("x", 1)}
    rep = {r["copies"]: (r["contents"], r["files"]) for r in files_src.duplicate_report(df).collect()}
    assert rep == {1: (1, 1), 2: (1, 2)}


def test_size_limit(spark):
    df = spark.createDataFrame([("a", 10), ("b", 11)], "file_name string, file_size bigint")
    ok, bad = files_src.check_size(df, 10)
    assert [r["file_name"] for r in ok.collect()] == ["a"]
    assert [(r["file_name"], r["code"]) for r in bad.collect()] == [("b", "INVALID_FILE")]
    assert bad.where(F.col("message").contains("10 bytes")).count() == 1


def test_files_of_rows(spark, tmp_path):
    texts = ["a", "a", None, "", "é\n\x00", "x" * 60] + [f"row {i}" for i in range(300)]
    out = tmp_path / "out"
    df = spark.createDataFrame([(x,) for x in texts], "text string").coalesce(2)
    files_src.write_files(df, str(out))
    want = sorted((x or "").encode() + b"\n" for x in texts)
    assert sorted(p.read_bytes() for p in out.rglob("*.txt")) == want
    # Folders do not grow with the rows, and nothing but the files is left.
    assert len([p for p in out.rglob("*") if p.is_dir()]) <= 4 and len([p for p in out.rglob("*") if p.is_file()]) == len(texts)
    # What an attempt left behind that did not end is no part of the folder.
    (out / "_7" / "00000").mkdir(parents=True)
    (out / "_7" / "00000" / "00000000.txt").write_bytes(b"half")
    files, rejects = files_src.ingest_files(spark, str(out), limit=50)
    assert sorted(r["checksum_sha256"] for r in files.collect()) == sorted(hashlib.sha256(x).hexdigest() for x in want if len(x) <= 50)
    assert [r["file_size"] for r in rejects.collect()] == [61]
    with pytest.raises(FileExistsError):
        files_src.write_files(df, str(out))


def test_files_of_rows_in_another_store(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.files.link./in", f"file://{tmp_path}")
    df = spark.createDataFrame([("a",), ("a",), (None,), ("é",)], "text string").coalesce(1)
    files_src.write_files(df, "viewfs://files/in/out")
    assert sorted(p.read_bytes() for p in (tmp_path / "out").glob("*.txt")) == sorted([b"a\n", b"a\n", b"\n", "é\n".encode()])
    assert files_src.ingest_files(spark, "viewfs://files/in/out")[0].count() == 4


def test_ingest_visits_each_file_once(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for i in range(33 * cores):
        (tmp_path / f"{i}.txt").write_bytes(b"x" * (i % 9 + 1))
    files, rejects = files_src.ingest_files(spark, str(tmp_path), limit=9)
    assert files.count() == 33 * cores and rejects.count() == 0
    # Small files share tasks, and the scan for rejects has none.
    assert files.rdd.getNumPartitions() <= cores and rejects.rdd.getNumPartitions() == 0
    files, rejects = files_src.ingest_files(spark, str(tmp_path), limit=4)
    assert files.count() + rejects.count() == 33 * cores and files.agg({"file_size": "max"}).first()[0] == 4
    assert rejects.agg({"file_size": "min"}).first()[0] == 5


def test_ingest_query_writes_a_file_per_document(spark, tmp_path, monkeypatch):
    # An id that comes twice, or none at all, is a file of its own like any other.
    rows = [(i % 150, f"text {i}") for i in range(298)] + [(None, "n"), (None, "x" * 9000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    monkeypatch.setattr(q_sources, "shared_dir", lambda _: str(tmp_path / "files"))
    monkeypatch.setattr(tables, "SPREAD_BYTES", -1)
    got = q_sources.ingest(spark, str(tmp_path / "sf")).collect()
    want = [hashlib.sha256(f"{x}\n".encode()).hexdigest() for _, x in rows if len(x) <= 8191]
    assert sorted(r["file_id"] for r in got if r["file_id"]) == sorted(f"file_{x}" for x in want)
    assert [(r["file_size"], r["code"]) for r in got if not r["file_id"]] == [(9001, "INVALID_FILE")]
    assert len([p for p in (tmp_path / "files").rglob("*") if p.is_dir()]) <= 4
