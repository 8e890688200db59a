import json

import pytest

from docspark.operators import validate as V
from docspark.plans import jobs as Jb
from docspark.plans.config import Configuration, EnrichmentOptions, ExtractionOptions, PageClass, ParsingOptions

SCHEMA = json.dumps({"type": "object", "properties": {"total": {"type": "number"}}, "required": ["total"]})
FULL = Configuration(
    ParsingOptions(chunking_strategy="page", ignore_sections=("page_number",), remove_strikethrough_lines=True),
    extraction=(
        ExtractionOptions("per_page", SCHEMA, partition_strategy="page"),
        ExtractionOptions("invoices", SCHEMA, page_classes=("invoice",)),
    ),
    page_classes=(PageClass("invoice", "invoice total"), PageClass("letter", "dear regards")),
)
TEXT = "Invoice\ntotal: 12.5\npage 1\nold ~~price~~ note and some more words to be a text\f" "dear reader\nkind regards\n"


@pytest.fixture
def result(spark):
    docs = spark.createDataFrame([(1, TEXT)], "doc_id int, text string")
    return Jb.run_dataset(docs, FULL, "parse")


def test_full_job(result):
    r = Jb.assemble(result, "doc_id").first()
    assert r["status"] == "successful" and r["error"] is None
    assert [len(p["page_fragments"]) for p in r["pages"]] == [3, 2]
    assert [p["classification_reason"] for p in r["pages"]] == ["invoice, total", "dear, regards"]
    assert [(c["page_class"], c["page_numbers"]) for c in r["page_classes"]] == [("invoice", [1]), ("letter", [2])]
    assert [c["page_number"] for c in r["chunks"]] == [1, 2]
    assert "price" not in r["chunks"][0]["content"]
    assert [(s["schema_name"], s["page_numbers"], s["data"]) for s in r["structured_data"]] == [
        ("per_page", [1], '{"total":12.5}'), ("invoices", [1], '{"total":12.5}'),
    ]
    assert r["usage"]["pages_parsed"] == 2 and r["usage"]["ocr_input_tokens_used"] == 0


def test_missing_fields_are_rejects(result):
    ok, bad = Jb.structured_rows(result)
    assert ok.count() == 2
    assert [(r["schema_name"], r["message"]) for r in bad.collect()] == [("per_page", "missing required: total")]


@pytest.mark.parametrize("job_type, have", [
    ("read", {"chunks"}), ("extract", {"structured_data"}), ("classify", {"page_classes"}),
    ("dataset", {"chunks", "structured_data", "page_classes"}),
])
def test_presets(spark, job_type, have):
    docs = spark.createDataFrame([(1, TEXT)], "doc_id int, text string")
    r = Jb.assemble(Jb.run_dataset(docs, FULL, job_type), "doc_id").first()
    assert {c for c in ("chunks", "structured_data", "page_classes") if r[c] is not None} == have
    assert r["job_type"] == job_type


def test_presets_need_their_options(spark):
    docs = spark.createDataFrame([(1, TEXT)], "doc_id int, text string")
    for kind in ("extract", "classify"):
        with pytest.raises(ValueError):
            Jb.run_dataset(docs, Configuration(), kind)


def test_many_configurations_in_one_scan(spark):
    rows = [(1, TEXT, "a", "parse"), (2, TEXT, "b", "read"), (3, TEXT, "b", "extract"), (4, TEXT, "zz", "read"), (5, TEXT, "a", "extract"), (6, TEXT, None, "read")]
    df = spark.createDataFrame(rows, "parse_id int, text string, dataset_id string, job_type string")
    out, rejects = Jb.run_jobs(df, {"a": FULL, "b": Configuration(ParsingOptions(chunking_strategy="fragment"))})
    assert {r["parse_id"]: r["code"] for r in rejects.collect()} == {3: "INVALID_CONFIGURATION", 4: "ENTITY_NOT_FOUND", 6: "ENTITY_NOT_FOUND"}
    got = {r["parse_id"]: r for r in out.collect()}
    assert set(got) == {1, 2, 5}
    assert len(got[1]["chunks"]) == 2 and len(got[2]["chunks"]) == 6
    assert got[2]["structured_data"] is None and len(got[5]["structured_data"]) == 2
    assert got[5]["chunks"] is None and got[2]["page_classes"] is None


def test_failed_jobs_have_no_usage(spark):
    docs = spark.createDataFrame([(1, TEXT, "failure", "bad scan")], "doc_id int, text string, status string, error string")
    r = Jb.assemble(Jb.run_dataset(docs, Configuration(), "read"), "doc_id").first()
    assert (r["status"], r["error"], r["usage"]) == ("failure", "bad scan", None)


def test_page_range_per_document(spark):
    docs = spark.createDataFrame([(1, "a\fb\fc", "2-3"), (2, "a\fb", None)], "doc_id int, text string, page_range string")
    got = {r["doc_id"]: r for r in Jb.assemble(Jb.run_dataset(docs, Configuration(), "read"), "doc_id").collect()}
    assert [p["page_number"] for p in got[1]["pages"]] == [2, 3] and got[1]["total_pages"] == 3
    assert len(got[2]["pages"]) == 2


def test_configuration_round_trip():
    assert Configuration.from_json(FULL.to_json()) == FULL
    for make in (
        lambda: ParsingOptions(chunking_strategy="semantic"),
        lambda: ParsingOptions(ignore_sections=("nothing",)),
        lambda: ExtractionOptions("s", SCHEMA, partition_strategy="half"),
        lambda: ExtractionOptions("s", "[]"),
    ):
        with pytest.raises(ValueError):
            make()


def test_joins_of_the_data_model(spark):
    requests = spark.createDataFrame([(1, "d", None), (2, "d", "3"), (3, None, None)], "parse_id int, dataset_id string, page_range string")
    datasets = spark.createDataFrame([("d", "cfg", "1-2")], "dataset_id string, configuration string, page_range string")
    got = {r["parse_id"]: (r["configuration"], r["page_range"]) for r in Jb.apply_dataset(requests, datasets).collect()}
    assert got == {1: ("cfg", "1-2"), 2: ("cfg", "3"), 3: (None, None)}
    docs = spark.createDataFrame([(1, "invoice"), (2, "memo")], "id int, doc_type string")
    routes = spark.createDataFrame([("invoice", "d")], "doc_type string, dataset_id string")
    assert {r["id"]: r["dataset_id"] for r in Jb.route(docs, routes).collect()} == {1: "d", 2: None}


REQ = "id int, job_type string, file_id string, file_url string, raw_text string, page_range string, mime_type string, schema_count int, class_count int, json_schema string, dataset_name string"


def test_validation(spark):
    ok_row = ("parse", "file_1", None, None, "1-3", "application/pdf", 0, 0, None, None)
    cases = {
        1: ok_row,
        2: ("parse", "file_1", "https://x", None, "bad", None, 0, 0, None, None),
        3: ("extract", "file_1", None, None, None, None, 0, 0, None, None),
        4: ("classify", "file_1", None, None, None, None, 1, None, None, None),
        5: ("parse", "file_1", None, None, "3-1", None, 0, 0, None, None),
        6: ("parse", "file_1", None, None, "", "a/b", 0, 0, None, None),
        7: ("extract", None, None, "text", None, "", 1, 0, "{", None),
        8: ("extract", None, None, "text", None, "", 1, 0, '{"type":"object"}', "no spaces"),
        9: ("extract", None, None, "text", None, "", 1, 0, '{"type":"object"}', "fine-name"),
    }
    df = spark.createDataFrame([(i, *row) for i, row in cases.items()], REQ)
    ok, rejects = V.validate(df)
    assert {r["id"] for r in ok.collect()} == {1, 9}
    assert {r["id"]: r["code"] for r in rejects.collect()} == {
        2: "INVALID_FILE", 3: "INVALID_CONFIGURATION", 4: "INVALID_PAGE_CLASSIFICATION", 5: "INVALID_PAGE_RANGE",
        6: "INVALID_MIME_TYPE", 7: "INVALID_JSON_SCHEMA", 8: "INVALID_DATASET_NAME",
    }


def test_unknown_ids(spark):
    req = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, dataset_id string")
    known = spark.createDataFrame([("a",), ("a",)], "dataset_id string")
    ok, bad = V.check_known(req, known, "dataset_id")
    assert {r["id"] for r in ok.collect()} == {1, 3}
    assert [(r["id"], r["code"]) for r in bad.collect()] == [(2, "ENTITY_NOT_FOUND")]


def job(spark, text, parsing=None, **kw):
    config = Configuration(ParsingOptions(**(parsing or {})), **kw)
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    return Jb.assemble(Jb.run_dataset(docs, config, "parse"), "doc_id").first()


def kinds(r):
    return [f["fragment_type"] for p in r["pages"] for f in p["page_fragments"]]


def test_detections_are_off_by_default(spark):
    text = "Signed: me\n~~gone~~\nname: Ann\n" + "w" * 60
    assert kinds(job(spark, text)) == ["title", "section_header", "section_header", "text"]
    on = job(spark, text, {"signature_detection": True, "remove_strikethrough_lines": True},
             enrichment=EnrichmentOptions(key_value_extraction=True))
    assert kinds(on) == ["signature", "key_value_region", "text"]
    assert on["usage"]["signature_detected_pages"] == 1 and on["usage"]["strikethrough_detected_pages"] == 1


def test_layout_detection_off(spark):
    r = job(spark, "# a\n| b | c |\n", {"disable_layout_detection": True})
    assert kinds(r) == ["text"] and r["chunks"][0]["content"] == "# a\n| b | c |"


def test_table_output(spark):
    text = "| a & b | c |"
    html = job(spark, text)["pages"][0]["page_fragments"][0]["content"]["table"]
    assert html["html"] == "<table><tr><td>a &amp; b</td><td>c</td></tr></table>" and html["markdown"] is None
    assert [c["text"] for c in html["cells"]] == ["a & b", "c"] and html["summary"] is None
    md = job(spark, text, {"table_output_mode": "markdown"}, enrichment=EnrichmentOptions(table_summarization=True))
    table = md["pages"][0]["page_fragments"][0]["content"]["table"]
    assert table["markdown"] == "| a & b | c |\n| --- | --- |" and table["html"] is None
    assert table["summary"] == "1 rows, 2 columns; first row: a & b, c"


def test_merged_tables_in_results(spark):
    text = "a | b\nc | d\fe | f\fno table on this page but a line that is long enough\fg | h\fi | j | k\fl | m | n\fo | p | q"
    assert job(spark, text)["merged_tables"] is None
    got = job(spark, text, {"merge_tables": True})["merged_tables"]
    assert [(m["start_page"], m["end_page"], m["pages_merged"], m["merge_actions"]["target_columns"]) for m in got] == [
        (1, 2, 2, 2), (5, 7, 3, 3),
    ]
    assert got[0]["merged_table_html"].count("<tr>") == 3 and got[1]["merge_actions"]["pages"] == [5, 6, 7]


def test_citations_on_request(spark):
    text = "x" * 90 + "\f" + "y" * 20 + "\ntotal: 12.5\n"
    options = ExtractionOptions("s", SCHEMA, provide_citations=True)
    got = job(spark, text, extraction=(options,))["structured_data"][0]
    assert [tuple(c) for c in got["citations"]] == [("total", 2, text.index("12.5"))]
    plain = job(spark, text, extraction=(ExtractionOptions("s", SCHEMA),))["structured_data"][0]
    assert plain["citations"] is None


def test_web_pages_and_texts_in_one_job(spark):
    html = "<html><head><title>t</title></head><body><nav>menu</nav><h1>Head</h1><p>some text about an invoice total<p>more</body>"
    rows = [(1, html, "text/html"), (2, "# Head\nplain", "text/plain"), (3, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, mime_type string")
    config = Configuration(ParsingOptions(chunking_strategy="section"), page_classes=(PageClass("invoice", "invoice total"),))
    got = {r["doc_id"]: r for r in Jb.assemble(Jb.run_dataset(docs, config, "parse"), "doc_id").collect()}
    assert kinds(got[1]) == ["page_header", "title", "text", "text"] and got[1]["total_pages"] == 1
    assert [c["page_class"] for c in got[1]["page_classes"]] == ["invoice"]
    assert kinds(got[2]) == ["section_header", "section_header"] and got[2]["page_classes"] == []
    assert kinds(got[3]) == ["title"]


def test_read_documents(spark, tmp_path):
    from docspark.sources import files as files_src

    (tmp_path / "a.html").write_text("<h1>Tïtle</h1>")
    (tmp_path / "b.txt").write_text("plain é")
    (tmp_path / "c.pdf").write_bytes(b"%PDF")
    docs, rejects = files_src.read_documents(spark, str(tmp_path))
    assert {r["file_name"]: (r["mime_type"], r["text"]) for r in docs.collect()} == {
        "a.html": ("text/html", "<h1>Tïtle</h1>"), "b.txt": ("text/plain", "plain é"),
    }
    assert [(r["file_name"], r["code"]) for r in rejects.collect()] == [("c.pdf", "INVALID_MIME_TYPE")]
    out = Jb.assemble(Jb.run_dataset(docs, Configuration(), "read", "file_id"), "file_id")
    assert out.count() == 2


def test_lines_of_bars_are_one_table(spark):
    r = job(spark, "Title of it\nsome words here that make a line of text, long enough\n| a | b |\n|---|---|\n| 1 | 2 |\n")
    tables = [f["content"]["table"] for f in r["pages"][0]["page_fragments"] if f["fragment_type"] == "table"]
    assert len(tables) == 1
    assert tables[0]["html"] == "<table><tr><td>a</td><td>b</td></tr><tr><td>1</td><td>2</td></tr></table>"
    assert [c["text"] for c in tables[0]["cells"]] == ["a", "b", "1", "2"]


def test_citations_stay_in_their_partition(spark):
    text = "Invoice of the month\ntotal: 7\n\fInvoice of the month\ntotal: 7\n"
    config = Configuration(extraction=(ExtractionOptions("t", SCHEMA, partition_strategy="page", provide_citations=True),))
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    r = Jb.assemble(Jb.run_dataset(docs, config, "extract"), "doc_id").first()
    cited = [(c["page_number"], c["offset"]) for s in r["structured_data"] for c in s["citations"]]
    second = text.index("\f")
    assert cited == [(1, text.index("7")), (2, text.index("7", second))]


def test_citations_point_at_the_labelled_value(spark):
    # The number stands before in prose, in an ignored fragment, behind blanks and markers, and next to a struck one.
    text = "Order of 12 items, which is the title of this\n   - total: 12  \n\fnothing\n# total: 12\n~~5~~ total: ~~11~~ 12\n{x} 漢字\n\ttotal: 12"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    for strategy in ("none", "page", "fragment"):
        for off in (False, True):
            config = Configuration(
                ParsingOptions(remove_strikethrough_lines=True, disable_layout_detection=off),
                extraction=(ExtractionOptions("t", SCHEMA, partition_strategy=strategy, provide_citations=True),))
            r = Jb.assemble(Jb.run_dataset(docs, config, "extract"), "doc_id").first()
            cited = [(c["page_number"], c["offset"]) for s in r["structured_data"] for c in s["citations"]]
            assert cited and all(text[o: o + 2] == "12" and text[:o].rstrip(" ").endswith((":", "~~")) for _, o in cited)
            assert all(page == 1 + text[:o].count("\f") for page, o in cited)
            if strategy == "fragment" and not off:
                assert len(cited) == 4


def test_citations_in_web_pages(spark):
    html = ("<html><head><title>total: 1</title></head><body>lead &amp; text<nav>total 12</nav><h1>An &lt;order&gt;</h1><p>price list</p>"
            "<p>total: 12<table><tr><td>12</td><td>b</td></tr></table><div>total: 34</div> tail</body></html>")
    docs = spark.createDataFrame([(1, html, "text/html")], "doc_id int, text string, mime_type string")
    config = Configuration(extraction=(ExtractionOptions("t", SCHEMA, partition_strategy="fragment", provide_citations=True),))
    from docspark.operators import fragments as G

    seen = docs.select(G.html_visible("text")).first()[0]
    r = Jb.assemble(Jb.run_dataset(docs, config, "extract"), "doc_id").first()
    cited = [c["offset"] for s in r["structured_data"] for c in s["citations"]]
    assert cited == [seen.index("total: 12") + 7, seen.index("total: 34") + 7]


def test_an_extraction_without_its_field_fails(spark):
    config = Configuration(extraction=(ExtractionOptions("t", SCHEMA),))
    docs = spark.createDataFrame([(1, "nothing here"), (2, "total: 3")], "doc_id int, text string")
    got = {r["doc_id"]: (r["status"], r["error"], r["usage"] is None) for r in Jb.assemble(Jb.run_dataset(docs, config, "extract"), "doc_id").collect()}
    assert got == {1: ("failure", "missing required: total", True), 2: ("successful", None, False)}
