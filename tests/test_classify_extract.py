import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions import hooks
from docspark.functions import json_schema as J
from docspark.operators import classify as K
from docspark.operators import extract as X
from docspark.operators import pages as P

PAGES = [(1, 1, "The invoice total and the due date"), (1, 2, "dear sir, kind regards"), (1, 3, "nothing here"),
         (2, 1, "INVOICE regards"), (2, 2, "")]
CLASSES = [(0, "invoice", "invoice total due"), (1, "letter", "dear regards"), (2, "other", ""), (3, "twin", "due invoice total")]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "doc_id int, page_number int, text string")


@pytest.fixture
def classes(spark):
    return spark.createDataFrame(CLASSES, "class_no int, name string, description string")


def test_scorer_join_and_row_form_agree(spark, pages, classes):
    want = {
        (1, 1): ("invoice", 1.0, "due, invoice, total"),
        (1, 2): ("letter", 1.0, "dear, regards"),
        (2, 1): ("letter", 0.5, "regards"),
    }
    constant = F.array(*[
        F.struct(F.lit(n).alias("class_no"), F.lit(c).alias("page_class"), K.terms(F.lit(d or c)).alias("terms"))
        for n, c, d in CLASSES
    ])
    in_row = pages.select("doc_id", "page_number", K.best_class(K.terms("text"), constant).alias("b")).where(
        "b is not null").select("doc_id", "page_number", "b.*")
    for got in (K.classify_pages(pages, classes), K.classify_pages_join(pages, classes), in_row):
        assert {(r[0], r[1]): (r["page_class"], r["score"], r["reason"]) for r in got.collect()} == want


def test_threshold(pages, classes):
    for how in (K.classify_pages, K.classify_pages_join):
        assert how(pages, classes, 0.6).count() == 2


@pytest.mark.parametrize("threshold", [0.0, 0.1, 0.25, 0.3, 0.5, 0.75, 1.0, 1.5])
def test_prefix_join_equals_counting(spark, threshold):
    rng = random.Random(5)
    # Some words are on most pages, most on few; ties, repeated words and empty texts occur.
    words = [f"w{i}" for i in range(60)]
    draw = lambda n: " ".join(words[int(60 * rng.random() ** 2)] for _ in range(n))
    texts = [(d, p, draw(rng.choice([0, 1, 5, 20]))) for d in range(40) for p in (1, 2)]
    kinds = [(n, f"c{n}", draw(rng.choice([0, 1, 2, 10, 30]))) for n in range(50)]
    p = spark.createDataFrame(texts, "doc_id int, page_number int, text string")
    c = spark.createDataFrame(kinds, "class_no int, name string, description string")
    want = {}
    sets = [(n, name, set((text or name).split())) for n, name, text in kinds]
    for d, no, text in texts:
        have = set(text.split())
        scores = [(len(v & have) / len(v), -n, name, ", ".join(sorted(v & have))) for n, name, v in sets]
        top = max(scores)
        if top[0] > 0 and top[0] >= threshold:
            want[d, no] = (top[2], top[0], top[3])
    for how in (K.classify_pages, K.classify_pages_join):
        rows = how(p, c, threshold).collect()
        assert {(r[0], r[1]): tuple(r[2:]) for r in (tuple(r) for r in rows)} == want
        assert len(rows) == len(want)


def test_rows_before_the_check_are_few(spark):
    """Every class shares a common word with every page; candidates need a rarer one."""
    p = spark.range(300).selectExpr("id AS doc_id", "1 AS page_number", "concat('the report of item', id, ' total', id) AS text")
    c = spark.range(200).selectExpr(
        "int(id) AS class_no", "string(id) AS name", "concat('the report of item', id, ' total', id) AS description")
    lists = K.class_terms(c)
    known = K.known_terms(p, lists, ["doc_id", "page_number"])
    assert K.candidates(known, K.rare_first(lists, known), 0.75).count() == 200
    assert K.classify_pages(p, c, 0.75).where("page_class = string(doc_id) AND score = 1").count() == 200


def test_null_keys_and_empty_inputs(spark, pages, classes):
    odd = spark.createDataFrame(
        [(None, 1, "dear regards"), (None, 1, "dear regards"), (5, None, None)], "doc_id int, page_number int, text string")
    assert [tuple(r) for r in K.classify_pages(odd, classes).collect()] == [(None, 1, "letter", 1.0, "dear, regards")]
    assert K.classify_pages(pages.limit(0), classes).count() == 0
    assert K.classify_pages(pages, classes.limit(0)).count() == 0


def test_page_class_output(spark, pages, classes):
    rows = K.collect_page_classes(K.classify_pages(pages, classes)).collect()
    got = {(r["doc_id"], r["page_class"]): (r["page_numbers"], r["classification_reasons"]) for r in rows}
    assert got[(1, "invoice")] == ([1], {1: "due, invoice, total"})
    labels = K.classify_pages(pages, classes)
    assert K.pages_in_classes(pages, labels, ["letter"]).count() == 2
    assert K.pages_in_classes(pages, labels, []).count() == 5


def test_classifier_hook(pages):
    hook = hooks.page_classifier(lambda t: pd.DataFrame({"page_class": t.str[:3], "score": 1.0, "reason": "first letters"}))
    got = pages.select(hook(F.col("text")).alias("b")).where("b.page_class = 'The'")
    assert got.first()["b"]["reason"] == "first letters"


ADDRESS = {"type": "object", "properties": {k: {"type": "string"} for k in ("street", "city", "state", "zip_code")}}
STATEMENT = {
    "type": "object",
    "properties": {
        "account_number": {"type": "string"},
        "bank_address": ADDRESS,
        "ending_balance": {"type": "number"},
        "table_item": {"type": "array", "items": {"type": "object", "properties": {
            "transaction_deposit": {"type": "number"}, "transaction_deposit_date": {"type": "string"}}}},
        "others": {"type": "object", "additionalProperties": True},
    },
    "required": ["account_number", "ending_balance"],
}


def test_json_schema_types():
    t = J.json_schema_to_struct(json.dumps(STATEMENT))
    assert t["bank_address"].dataType.names == ["street", "city", "state", "zip_code"]
    assert isinstance(t["ending_balance"].dataType, T.DoubleType)
    assert isinstance(t["table_item"].dataType.elementType, T.StructType)
    assert isinstance(t["others"].dataType, T.VariantType)
    assert J.required(STATEMENT) == [("account_number",), ("ending_balance",)]
    for bad in ("[1]", "no json", '{"type":"string"}', '{"type":"object","properties":{"a":{"type":"date"}}}'):
        with pytest.raises(J.InvalidJsonSchema):
            J.json_schema_to_struct(bad)


def test_json_schema_references_unions_and_enums():
    schema = {
        "type": "object", "$defs": {"place": {"type": "object", "properties": {"city": {"type": "string"}}, "required": ["city"]}},
        "properties": {
            "home": {"$ref": "#/$defs/place"}, "size": {"anyOf": [{"type": "number"}, {"type": "null"}]}, "kind": {"enum": ["a", "b"]},
        },
        "required": ["kind"],
    }
    t = J.json_schema_to_struct(schema)
    assert t["home"].dataType.names == ["city"] and isinstance(t["size"].dataType, T.DoubleType)
    assert isinstance(t["kind"].dataType, T.StringType)
    assert J.required(schema) == [("kind",), ("home", "city")]
    loop = {"type": "object", "$defs": {"n": {"type": "object", "properties": {"n": {"$ref": "#/$defs/n"}}}}, "properties": {"n": {"$ref": "#/$defs/n"}}}
    for bad in (loop, {**schema, "required": ["other"]}, {"type": "object", "properties": {"a": {"$ref": "#/nowhere"}}}):
        with pytest.raises(J.InvalidJsonSchema):
            J.json_schema_to_struct(bad)


def test_nested_required(spark):
    schema = {"type": "object", "properties": {"a": {"type": "object", "properties": {"b": {"type": "string"}, "c": {"type": "string"}}, "required": ["b"]}}}
    p = parts(spark, '{"a":{"c":"x"}}', '{"a":{"b":"y"}}', "{}")
    out, rejects = X.extract(p, "s", schema)
    assert {r["doc_id"] for r in out.collect()} == {1, 2}
    assert [r["message"] for r in rejects.collect()] == ["missing required: a.b"]


def test_names_are_text_not_patterns(spark):
    schema = {"type": "object", "properties": {"price($)": {"type": "number"}, "a(b": {"type": "string"}, "x_y": {"type": "string"}}}
    out, _ = X.extract(parts(spark, "Price($): 3\na(b: q\nx y: z\n"), "s", schema)
    assert json.loads(out.first()["data"]) == {"price($)": 3.0, "a(b": "q", "x_y": "z"}


def parts(spark, *texts):
    rows = [(i, t, 0, [1]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id int, text string, partition_no int, page_numbers array<int>")


def test_extract_from_json_and_prose(spark):
    doc = {"account_number": "7", "bank_address": {"city": "Bonn"}, "ending_balance": 1.5,
           "table_item": [{"transaction_deposit": 2.0}], "others": {"x": [1]}}
    p = parts(spark, json.dumps(doc), "Account number: 9\nBank address city: Ulm\nending balance: 3\n", "nothing", "{broken")
    out, rejects = X.extract(p, "s", STATEMENT)
    got = {r["doc_id"]: json.loads(r["data"]) for r in out.collect()}
    assert got[0] == doc
    assert got[1]["account_number"] == "9" and got[1]["ending_balance"] == 3.0 and got[1]["bank_address"] == {"city": "Ulm"}
    assert sorted((r["doc_id"], r["code"], r["message"]) for r in rejects.collect()) == [
        (2, "INVALID_JSON_SCHEMA", "missing required: account_number, ending_balance"),
        (3, "INVALID_JSON_SCHEMA", "missing required: account_number, ending_balance"),
    ]


def test_bad_values_are_missing_not_fatal(spark):
    schema = {"type": "object", "properties": {"n": {"type": "integer"}, "ok": {"type": "boolean"}, "l": {"type": "array", "items": {"type": "integer"}}}}
    out, _ = X.extract(parts(spark, "n: many\nok: true\nl: 1, 2, x"), "s", schema)
    assert json.loads(out.first()["data"]) == {"ok": True, "l": [1, 2, None]}


def test_key_values(spark):
    df = spark.createDataFrame([(1, "A b: one: two\nno pair\nc_1:   x  \n: empty key\nd:")], "doc_id int, text string")
    assert [(r["pair_no"], r["key_name"], r["value"]) for r in X.key_values(df).collect()] == [
        (0, "A b", "one: two"), (1, "c_1", "x"),
    ]


def test_cite(spark):
    text = "a" * 10 + "\f" + "b" * 20 + "needle" + "\f" + "c"
    docs = spark.createDataFrame([(1, text, "needle", "absent")], "doc_id int, text string, x string, y string")
    values = X.value_offsets(docs, ["x", "y"])
    for bucket in (3, 7, 3000):
        got = X.cite(values, P.split_pages(docs), bucket=bucket).collect()
        assert [(r["field"], r["offset"], r["page_number"], r["page_offset"]) for r in got] == [("x", 31, 2, 20)]
    in_row = P.with_pages(docs).select(X.cite_in_row("pages", F.lit(31)).alias("p"))
    assert in_row.first()["p"] == 2
