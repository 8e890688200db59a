"""Scalar functions (SCL) over the driver tables."""

from pyspark.sql import functions as F

from docspark.functions import json_schema as J
from docspark.functions import scalars as S
from docspark.operators import validate as V
from docspark.workload import tables as t
from docspark.workload.registry import query


@query("scl_1_union_values", """
SELECT o_orderkey, CASE WHEN k = 0 THEN CAST(o_custkey AS VARCHAR)
    WHEN k = 1 THEN CAST(o_custkey AS VARCHAR) || ',' || CAST(o_custkey + 1 AS VARCHAR) END AS vals, k <> 3 AS valid
FROM (SELECT *, o_orderkey % 4 AS k FROM orders)""")
def union_values(spark, sf_dir):
    o = t.load(spark, sf_dir, "orders")
    c, k = F.col("o_custkey").cast("string"), F.col("o_orderkey") % 4
    raw = (
        F.when(k == 0, F.concat(F.lit(" "), c))
        .when(k == 1, F.concat(F.lit("["), c, F.lit(" , "), (F.col("o_custkey") + 1).cast("string"), F.lit("]")))
        .when(k == 2, F.lit("null"))
        .otherwise(F.concat(F.lit('"'), c, F.lit('"')))
    )
    d = o.select("o_orderkey", raw.alias("raw"))
    return d.select(
        "o_orderkey",
        F.array_join(S.union_values("raw").cast("array<string>"), ",").alias("vals"),
        S.union_values_valid("raw").alias("valid"),
    )


@query("scl_2_page_range", """
SELECT doc_id, valid, CASE WHEN valid THEN (SELECT string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) FROM
     (SELECT DISTINCT unnest(generate_series(1, 12)) AS p) WHERE p BETWEEN a AND b OR p = c) END AS page_list
FROM (SELECT doc_id, doc_id % 7 AS a, doc_id % 7 + doc_id % 4 - 1 AS b, doc_id % 13 AS c,
             doc_id % 7 >= 1 AND doc_id % 4 >= 1 AND doc_id % 13 >= 1 AND doc_id % 5 <> 0 AS valid FROM documents)""")
def page_range(spark, sf_dir):
    d = t.load(spark, sf_dir, "documents")
    i = F.col("doc_id")
    text = F.concat_ws(
        "", (i % 7).cast("string"), F.lit("-"), (i % 7 + i % 4 - 1).cast("string"), F.lit(", "), (i % 13).cast("string"),
        F.when(i % 5 == 0, ";"),
    )
    r = d.select("doc_id", text.alias("r"))
    return r.select(
        "doc_id",
        S.page_range_valid("r").alias("valid"),
        F.array_join(S.page_range("r", F.lit(12)).cast("array<string>"), ",").alias("page_list"),
    )


@query("scl_3_timestamps", """
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE epoch_us(date_trunc('second', ts)) END AS from_rfc3339,
       epoch_us(date_trunc('millisecond', ts)) AS from_millis
FROM events""")
def timestamps(spark, sf_dir):
    e = t.load(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    text = F.when(F.col("event_id") % 9 == 0, F.date_format("at", "dd.MM.yyyy")).otherwise(
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    d = e.select("event_id", text.alias("text"), F.unix_millis("at").alias("ms"))
    return d.select(
        "event_id",
        F.unix_micros(S.ts_rfc3339("text")).alias("from_rfc3339"),
        F.unix_micros(S.ts_millis("ms")).alias("from_millis"),
    )


@query("scl_4_dataset_names", """
SELECT p_partkey, p_name, regexp_matches(p_name, '^[A-Za-z0-9_-]+$') AS name_ok,
       regexp_matches(replace(p_name, ' ', '_'), '^[A-Za-z0-9_-]+$') AS joined_ok
FROM part""")
def dataset_names(spark, sf_dir):
    return t.load(spark, sf_dir, "part").select(
        "p_partkey", "p_name", S.valid_dataset_name("p_name").alias("name_ok"),
        S.valid_dataset_name(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("joined_ok"),
    )


@query("scl_5_id_version", f"""WITH {t.FILES}
SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN 'v1' WHEN doc_id % 3 = 2 THEN NULL ELSE 'v2' END AS version FROM files""")
def id_version(spark, sf_dir):
    f = t.files(spark, sf_dir)
    fid = F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("old-"), F.col("checksum_sha256"))).when(
        F.col("doc_id") % 3 == 2, ""
    ).otherwise(F.col("file_id"))
    return f.select("doc_id", S.id_version(fid).alias("version"))


@query("scl_6_strip_scheme", """
SELECT page_id, regexp_replace(url, '^https?://((?s:.+))$', '\\1') AS bare,
       regexp_replace('http://', '^https?://((?s:.+))$', '\\1') AS lone FROM pages""")
def strip_scheme(spark, sf_dir):
    return t.load(spark, sf_dir, "pages").select(
        "page_id", S.strip_scheme("url").alias("bare"), S.strip_scheme(F.lit("http://")).alias("lone")
    )


@query("scl_7_base64", "SELECT page_id, to_base64(encode(url)) AS encoded, url AS decoded FROM pages")
def b64(spark, sf_dir):
    d = t.load(spark, sf_dir, "pages").select("page_id", S.b64_encode("url").alias("encoded"))
    return d.withColumn("decoded", S.b64_decode("encoded"))


CUSTOMER_SCHEMA = {
    "type": "object",
    "properties": {
        "account_number": {"type": "integer"},
        "client_name": {"type": "string"},
        "ending_balance": {"type": "number", "description": "last balance"},
        "active": {"type": "boolean"},
        "tags": {"type": "array", "items": {"type": "string"}},
        "address": {"type": "object", "properties": {"nation": {"type": "integer"}}},
    },
    "required": ["account_number", "client_name"],
}


@query("scl_8_json_schema", """
SELECT c_custkey AS account_number, c_name AS client_name, c_acctbal AS ending_balance, c_custkey % 2 = 0 AS active,
       c_mktsegment || '|x' AS tags, CAST(c_nationkey AS BIGINT) AS nation
FROM customer""")
def json_schema(spark, sf_dir):
    """Customers as JSON text, decoded by a compiled JSON Schema."""
    c = t.load(spark, sf_dir, "customer").select(
        F.to_json(F.struct(
            F.col("c_custkey").alias("account_number"),
            F.col("c_name").alias("client_name"),
            F.col("c_acctbal").alias("ending_balance"),
            (F.col("c_custkey") % 2 == 0).alias("active"),
            F.array("c_mktsegment", F.lit("x")).alias("tags"),
            F.struct(F.col("c_nationkey").alias("nation")).alias("address"),
        )).alias("json")
    )
    d = c.select(F.from_json("json", J.json_schema_to_struct(CUSTOMER_SCHEMA)).alias("d"))
    return d.select(
        "d.account_number", "d.client_name", "d.ending_balance", "d.active",
        F.array_join("d.tags", "|").alias("tags"), F.col("d.address.nation").alias("nation"),
    )


@query("scl_9_validate", """
SELECT o_orderkey,
  CASE WHEN (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END)
            + (CASE WHEN o_orderkey % 3 = 1 THEN 1 ELSE 0 END) <> 1 THEN 'INVALID_FILE'
       WHEN o_orderpriority = '3-MEDIUM' AND o_orderkey % 6 = 0 THEN 'INVALID_CONFIGURATION'
       WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderkey % 7 = 0 THEN 'INVALID_PAGE_CLASSIFICATION'
       WHEN o_orderkey % 9 = 0 THEN 'INVALID_PAGE_RANGE'
       WHEN o_orderkey % 10 = 0 THEN 'INVALID_MIME_TYPE'
       WHEN o_orderkey % 11 = 0 THEN 'INVALID_JSON_SCHEMA'
       WHEN o_orderkey % 13 = 0 THEN 'INVALID_DATASET_NAME' ELSE '' END AS code
FROM orders""")
def validate(spark, sf_dir):
    o = t.load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    requests = o.select(
        "o_orderkey",
        t._case("o_orderpriority", t.JOB_TYPE).alias("job_type"),
        F.when(k % 3 == 0, F.concat(F.lit("file_"), k.cast("string"))).alias("file_id"),
        F.when(k % 4 == 0, F.lit("https://example.com/a.pdf")).otherwise("").alias("file_url"),
        F.when(k % 3 == 1, F.lit("some text")).alias("raw_text"),
        F.when(k % 6 == 0, 0).otherwise(1).alias("schema_count"),
        F.when(k % 7 == 0, F.lit(None).cast("int")).otherwise(2).alias("class_count"),
        F.when(k % 9 == 0, "5-1").when(k % 2 == 0, "1-5,8").alias("page_range"),
        F.when(k % 10 == 0, "text/klingon").otherwise("text/plain").alias("mime_type"),
        F.when(k % 11 == 0, "[1]").when(k % 5 == 0, '{"type":"object"}').alias("json_schema"),
        F.when(k % 13 == 0, "my set").otherwise("my-set").alias("dataset_name"),
    )
    ok, rejects = V.validate(requests)
    return ok.select("o_orderkey", F.lit("").alias("code")).unionByName(rejects.select("o_orderkey", "code"))


@query("scl_10_error_text", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'sandbox error: ' || o_orderpriority || ' (code: ' || o_orderstatus || ')'
       ELSE 'sandbox error: ' || o_orderpriority END AS text,
       'code: ' || o_orderstatus || ', message: ' || o_orderpriority || ', trace_id: t' || o_orderkey || ', details: <nil>' AS api_text
FROM orders""")
def error_text(spark, sf_dir):
    k = F.col("o_orderkey")
    return t.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        S.error_text("o_orderpriority", F.when(k % 2 == 0, F.col("o_orderstatus")).otherwise("")).alias("text"),
        S.api_error_text(
            "o_orderstatus", "o_orderpriority", F.concat(F.lit("t"), k.cast("string")), F.lit(None).cast("string")
        ).alias("api_text"),
    )


@query("scl_11_peek", "SELECT doc_id, substr(text, 1, 100) AS preview FROM documents")
def peek(spark, sf_dir):
    return t.load(spark, sf_dir, "documents").select("doc_id", S.peek("text").alias("preview"))


@query("scl_12_labels", """
SELECT doc_id, '{"quality":"' || quality || '"' || CASE WHEN toxic = 1 THEN ',"toxic":"1"' ELSE '' END || '}' AS json,
       CAST(quality AS VARCHAR) AS quality FROM labels""")
def labels(spark, sf_dir):
    d = t.load(spark, sf_dir, "labels").select(
        "doc_id", S.label_map(quality="quality", toxic=F.when(F.col("toxic") == 1, F.col("toxic"))).alias("m")
    )
    j = d.select("doc_id", S.labels_json("m").alias("json"))
    return j.withColumn("quality", F.try_element_at(S.labels_from_json("json"), F.lit("quality")))
