import pytest
from pyspark.sql import functions as F

from docspark.functions import scalars as S


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())] if values else [(1,)], list(values) or ["x"])
    return df.select(col.alias("r")).first()["r"]


def text(spark, col, value):
    return spark.createDataFrame([(value,)], "v string").select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("raw, want, ok", [
    ("1", [1], True),
    ("[1, 2, 3]", [1, 2, 3], True),
    ("[]", [], True),
    (" 7 ", [7], True),
    ("-3", [-3], True),
    ("null", None, True),
    (None, None, True),
    ('"x"', None, False),
    ("[1, \"x\"]", None, False),
    ("{}", None, False),
    ("1.5", None, False),
    ("[1,]", None, False),
])
def test_union_values(spark, raw, want, ok):
    assert text(spark, S.union_values("v"), raw) == want
    assert text(spark, S.union_values_valid("v"), raw) is ok


def test_union_values_written_as_array(spark):
    assert text(spark, S.union_values_json(S.union_values("v")), "1") == "[1]"
    assert text(spark, S.union_values_json(S.union_values("v")), "[1, 2, 3]") == "[1,2,3]"


@pytest.mark.parametrize("raw, total, want", [
    ("1-5,8,10", 20, [1, 2, 3, 4, 5, 8, 10]),
    ("1,2,3-5", 4, [1, 2, 3, 4]),
    ("3, 1-2, 2", 9, [1, 2, 3]),
    ("7-9", 5, []),
    ("1-999999999", 3, [1, 2, 3]),
    ("5-1", 9, None),
    ("0-2", 9, None),
    ("a", 9, None),
    ("1-", 9, None),
    ("1;2", 9, None),
    ("1-2-3", 9, None),
])
def test_page_range(spark, raw, total, want):
    assert text(spark, S.page_range("v", F.lit(total)), raw) == want
    assert bool(text(spark, S.page_range_valid("v"), raw)) is (want is not None)


@pytest.mark.parametrize("sources, want", [
    (("file_1", "", ""), True),
    (("", "https://example.com", None), True),
    ((None, None, "text"), True),
    (("file_1", "https://example.com", ""), False),
    (("file_1", "https://example.com", "text"), False),
    (("", "", ""), False),
    ((None, None, None), False),
])
def test_source_provided(spark, sources, want):
    df = spark.createDataFrame([sources], "a string, b string, c string")
    assert df.select(S.source_provided("a", "b", "c").alias("r")).first()["r"] is want


@pytest.mark.parametrize("url, want", [
    ("https://example.com/x", "example.com/x"),
    ("http://example.com", "example.com"),
    ("https://", "https://"),
    ("http://", "http://"),
    ("example.com", "example.com"),
    ("ftp://example.com", "ftp://example.com"),
    ("https://http://a", "http://a"),
])
def test_strip_scheme(spark, url, want):
    assert text(spark, S.strip_scheme("v"), url) == want


def test_timestamps(spark):
    at = F.unix_millis(S.ts_rfc3339("v"))
    assert text(spark, at, "2024-01-01T00:00:00Z") == 1704067200000
    assert text(spark, at, "2024-01-01T01:00:00.25+01:00") == 1704067200250
    assert text(spark, at, "yesterday") is None
    assert text(spark, at, "2024-13-01T00:00:00Z") is None
    assert one(spark, F.unix_millis(S.ts_millis(F.lit(1704067200000)))) == 1704067200000


def test_names_ids_errors(spark):
    assert text(spark, S.valid_dataset_name("v"), "invoices-2024_a") is True
    assert text(spark, S.valid_dataset_name("v"), "invoices dataset") is False
    assert text(spark, S.valid_dataset_name("v"), "") is False
    assert text(spark, S.id_version("v"), "file_abc") == "v2"
    assert text(spark, S.id_version("v"), "older-abc") == "v1"
    assert text(spark, S.id_version("v"), "") is None
    assert text(spark, S.error_text("v", F.lit("")), "boom") == "sandbox error: boom"
    assert text(spark, S.error_text("v", F.lit("E1")), "boom") == "sandbox error: boom (code: E1)"


def test_base64_and_labels(spark):
    assert text(spark, S.b64_encode("v"), "abc") == "YWJj"
    assert text(spark, S.b64_decode("v"), "YWJj") == "abc"
    m = spark.createDataFrame([("x", None)], "a string, b string").select(S.label_map(a="a", b="b").alias("m"))
    assert m.first()["m"] == {"a": "x"}
    assert m.select(S.label_equals("m", "a", "x").alias("r")).first()["r"] is True
    assert m.select(S.label_equals("m", "b", "x").alias("r")).first()["r"] is False


def test_peek_counts_characters(spark):
    assert text(spark, S.peek("v"), "é" * 150) == "é" * 100
