import json

import pytest

from docspark.plans import jobs as Jb
from docspark.plans import requests as R
from docspark.plans.config import Configuration, EnrichmentOptions, ExtractionOptions, PageClass, ParsingOptions

NESTED = {
    "type": "object",
    "properties": {
        "total": {"type": "number"},
        "count": {"type": "integer"},
        "paid": {"type": "boolean"},
        "who": {"type": "object", "properties": {"name": {"type": "string"}, "at": {"type": "object", "properties": {"city": {"type": "string"}}}}, "required": ["name"]},
        "codes": {"type": "array", "items": {"type": "integer"}},
        "rows": {"type": "array", "items": {"type": "object", "properties": {"a": {"type": "integer"}}}},
    },
    "required": ["count", "total"],
}
PROSE = (
    "# Bill\ntotal: 12.5\nCount: 3\npaid: true\nwho name: Ann \"A\" \\ é\nwho_at_city: \t Rome\ncodes: 1, x, 3\n| a | b |\n| 1 | 2 |\npage 1\n"
    "~~old~~ new words ~~here~~ and more to make this a line of text\f| a | b |\n| 3 | 4 |\n## Part\ncount: many\ntotal: 7\nsincerely yours\n"
)
JSON = json.dumps({"count": 3, "total": 1.5, "who": {"name": "null", "extra": 1}, "codes": [1, 2], "rows": [{"a": 1}], "paid": None, "other": 5})
TEXTS = [PROSE, JSON, json.dumps({"total": 2}), "", None, "no fields at all"]
CONFIGS = {
    "default": Configuration(),
    "plain": Configuration(ParsingOptions(disable_layout_detection=True, chunking_strategy="page")),
    "read": Configuration(
        ParsingOptions(chunking_strategy="section", ignore_sections=("page_number",), remove_strikethrough_lines=True, signature_detection=True,
                       merge_tables=True, table_output_mode="markdown"),
        EnrichmentOptions(table_summarization=True, key_value_extraction=True)),
    "full": Configuration(
        ParsingOptions(chunking_strategy="fragment"),
        extraction=(
            ExtractionOptions("whole", json.dumps(NESTED), provide_citations=True),
            ExtractionOptions("paged", json.dumps(NESTED), partition_strategy="page", provide_citations=True),
            ExtractionOptions("bills", json.dumps({"type": "object", "properties": {"total": {"type": "number"}}}), page_classes=("bill",)),
            ExtractionOptions("cut", json.dumps({"type": "object", "properties": {"count": {"type": "string"}}}), partition_strategy="patterns",
                              start_pattern="^total", end_pattern="^(paid|count)"),
        ),
        page_classes=(PageClass("bill", "bill total paid"), PageClass("letter", "sincerely yours"))),
}


def plain(x):
    return json.dumps(x.asDict(recursive=True) if x is not None else None, sort_keys=True, default=str)


@pytest.mark.parametrize("job_type", ["parse", "extract"])
def test_equals_jobs_of_one_configuration(spark, job_type):
    names = [n for n, c in CONFIGS.items() if job_type == "parse" or c.extraction]
    rows = [(f"{n}/{i}", t, job_type, CONFIGS[n].to_json()) for n in names for i, t in enumerate(TEXTS)]
    out, rejects = R.run_requests(spark.createDataFrame(rows, "parse_id string, text string, job_type string, configuration string"))
    got = {r["parse_id"]: plain(r) for r in out.collect()}
    assert rejects.count() == 0
    for n in names:
        docs = spark.createDataFrame([(f"{n}/{i}", t or "") for i, t in enumerate(TEXTS)], "parse_id string, text string")
        want = {r["parse_id"]: plain(r) for r in Jb.assemble(Jb.run_dataset(docs, CONFIGS[n], job_type, "parse_id"), "parse_id").collect()}
        for k, v in want.items():
            assert got[k] == v, k


def test_own_options_over_those_of_the_dataset(spark):
    base = Configuration(ParsingOptions(chunking_strategy="fragment", ignore_sections=("table",)), page_classes=(PageClass("bill", "total"),))
    datasets = spark.createDataFrame([("d", base.to_json()), ("none", None)], "dataset_id string, configuration string")
    page = json.dumps({"parsing_options": {"chunking_strategy": "page", "ignore_sections": None}})
    rows = [
        (1, "read", "d", None), (2, "read", "d", page), (3, "read", None, page), (4, "read", None, None), (5, "read", "none", None),
        (6, "classify", "d", None), (7, "dataset", "d", None),
        (10, "read", "gone", page), (11, "dataset", None, page), (12, "read", "d", "{"), (13, "read", "d", '{"parsing_options": {"no_such": 1}}'),
        (14, "read", None, '{"parsing_options": {"chunking_strategy": "odd"}}'), (15, "extract", "d", None), (16, "classify", "none", None),
        (17, "extract", None, json.dumps({"structured_extraction_options": [{"schema_name": "x", "json_schema": "{\"type\": \"string\"}"}]})),
        (18, "read", "d", "[1]"),
    ]
    asked = spark.createDataFrame([(i, PROSE, *r) for i, *r in rows], "parse_id int, text string, job_type string, dataset_id string, configuration string")
    out, rejects = R.run_requests(asked, datasets)
    got = {r["parse_id"]: r for r in out.collect()}
    assert set(got) == set(range(1, 8))
    tables = {k: sum(f["fragment_type"] == "table" for p in r["pages"] for f in p["page_fragments"]) for k, r in got.items()}
    assert tables[1] == tables[2] == 0 and tables[3] == tables[4] == 2
    assert [len(got[k]["chunks"]) for k in (2, 3, 4, 5)] == [2, 2, 1, 1] and len(got[1]["chunks"]) > 5
    assert [c["page_class"] for c in got[6]["page_classes"]] == ["bill"] and got[7]["dataset_id"] == "d"
    assert {r["parse_id"]: r["code"] for r in rejects.collect()} == {
        10: "ENTITY_NOT_FOUND", 11: "ENTITY_NOT_FOUND", 12: "INVALID_CONFIGURATION", 13: "INVALID_CONFIGURATION", 14: "INVALID_CONFIGURATION",
        15: "INVALID_CONFIGURATION", 16: "INVALID_PAGE_CLASSIFICATION", 17: "INVALID_JSON_SCHEMA", 18: "INVALID_CONFIGURATION"}


def test_the_plan_does_not_grow_with_configurations(spark):
    def asked(n):
        rows = [(i, "total: 5", "extract", json.dumps({"structured_extraction_options": [{
            "schema_name": f"s{i % n}", "json_schema": json.dumps({"type": "object", "properties": {"total": {"type": "integer"}, f"f{i % n}": {"type": "string"}}})}]}))
            for i in range(1000)]
        return R.run_requests(spark.createDataFrame(rows, "parse_id int, text string, job_type string, configuration string"))[0]

    one, many = asked(1), asked(1000)
    sizes = [len(x._jdf.queryExecution().optimizedPlan().toString()) for x in (one, many)]
    assert abs(sizes[0] - sizes[1]) < 0.05 * sizes[0]
    got = many.select("structured_data").collect()
    assert len({r[0][0]["schema_name"] for r in got}) == 1000 and {r[0][0]["data"] for r in got} == {'{"total":5}'}


def test_no_requests(spark):
    out, rejects = R.run_requests(spark.createDataFrame([], "parse_id int, text string, job_type string, dataset_id string"),
                                  spark.createDataFrame([], "dataset_id string, configuration string"))
    assert out.count() == 0 and rejects.count() == 0
