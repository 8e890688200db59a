"""The driver tables in the roles of the document data model.

Each role exists twice: as a DataFrame and as a SQL common table expression for
the oracle, both plain projections of the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.operators import events as E
from docspark.sources import files as files_src


TEXT_TABLES = ("documents", "pages")
# The driver's small tables are one row group each, which one core reads; a
# table of more bytes has splits of its own and is never dealt out.
SPREAD_BYTES = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal a small one-file table out to the cores, so that row-local text work uses them."""
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SPREAD_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def micros(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp"))


def _case(col: str, values: dict, otherwise=None) -> Column:
    out = F.lit(otherwise)
    for k, v in reversed(list(values.items())):
        out = F.when(F.col(col) == k, v).otherwise(out)
    return out


def _sql_case(col: str, values: dict, otherwise: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE {col} {arms} ELSE {otherwise} END"


# ---- files ---------------------------------------------------------------

EXTENSIONS = {"en": "txt", "fr": "md", "de": "HTML", "es": "csv"}

FILES = f"""files AS (
  SELECT doc_id, text, lang, source, 'file_' || sha256(text) AS file_id, sha256(text) AS checksum_sha256,
         source || '/' || doc_id || '.' || {_sql_case("lang", EXTENSIONS, "'bin'")} AS file_name,
         strlen(text) AS file_size,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS created_at
  FROM documents)"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = files_src.from_raw_text(load(spark, sf_dir, "documents"))
    ext = _case("lang", EXTENSIONS, "bin")
    return d.withColumn(
        "file_name", F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit("."), ext)
    ).withColumn("created_at", F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60))


# ---- jobs and datasets ---------------------------------------------------

JOB_TYPE = {
    "1-URGENT": "parse", "2-HIGH": "read", "3-MEDIUM": "extract", "4-NOT SPECIFIED": "classify", "5-LOW": "dataset",
}

JOBS = f"""jobs AS (
  SELECT *, CASE WHEN status IN ('successful', 'failure') THEN created_at + to_seconds(parse_id % 97) END AS finished_at
  FROM (SELECT o_orderkey AS parse_id, o_custkey % 25 AS dataset_id,
               'file-' || (o_orderkey % 1000) || '.pdf' AS file_name,
               {_sql_case("o_orderpriority", JOB_TYPE)} AS job_type,
               CASE WHEN o_orderstatus = 'O' THEN 'pending'
                    WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 3 = 0 THEN 'detecting_layout' ELSE 'processing' END
                    WHEN o_orderpriority = '1-URGENT' THEN 'failure' ELSE 'successful' END AS status,
               o_orderdate AS created_at
        FROM orders))"""


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "O", "pending")
        .when(F.col("o_orderstatus") == "P", F.when(key % 3 == 0, "detecting_layout").otherwise("processing"))
        .when(F.col("o_orderpriority") == "1-URGENT", "failure")
        .otherwise("successful")
    )
    return o.select(
        key.alias("parse_id"),
        (F.col("o_custkey") % 25).alias("dataset_id"),
        F.concat(F.lit("file-"), (key % 1000).cast("string"), F.lit(".pdf")).alias("file_name"),
        _case("o_orderpriority", JOB_TYPE).alias("job_type"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_at"),
    ).withColumn(
        "finished_at",
        F.when(
            F.col("status").isin("successful", "failure"),
            F.col("created_at") + F.make_dt_interval(secs=(F.col("parse_id") % 97).cast("decimal(18,6)")),
        ),
    )


DATASETS = """datasets AS (
  SELECT CAST(n_nationkey AS BIGINT) AS dataset_id, n_name AS name, 'region ' || n_regionkey AS description,
         CASE WHEN n_regionkey % 2 = 0 THEN 'idle' ELSE 'processing' END AS status,
         CASE WHEN n_nationkey % 3 = 0 THEN '1-2' ELSE NULL END AS page_range,
         'text/plain' AS mime_type,
         CASE WHEN n_nationkey % 2 = 0 THEN 'page' ELSE 'section' END AS configuration
  FROM nation)"""


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    return n.select(
        key.cast("bigint").alias("dataset_id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("description"),
        F.when(F.col("n_regionkey") % 2 == 0, "idle").otherwise("processing").alias("status"),
        F.when(key % 3 == 0, "1-2").alias("page_range"),
        F.lit("text/plain").alias("mime_type"),
        F.when(key % 2 == 0, "page").otherwise("section").alias("configuration"),
    )


USAGE = """usage_rows AS (
  SELECT l_orderkey AS parse_id, 1 AS pages_parsed,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS signature_detected_pages,
         CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS strikethrough_detected_pages,
         CAST(l_quantity AS BIGINT) AS ocr_input_tokens_used,
         CAST(l_quantity AS BIGINT) * 2 AS ocr_output_tokens_used,
         CAST(l_linenumber AS BIGINT) AS extraction_input_tokens_used,
         l_suppkey AS extraction_output_tokens_used,
         l_partkey AS summarization_input_tokens_used,
         l_partkey % 7 AS summarization_output_tokens_used
  FROM lineitem)"""


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity").cast("bigint")
    flag = F.col("l_returnflag")
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("parse_id"),
        F.lit(1).cast("bigint").alias("pages_parsed"),
        (flag == "R").cast("bigint").alias("signature_detected_pages"),
        (flag == "A").cast("bigint").alias("strikethrough_detected_pages"),
        q.alias("ocr_input_tokens_used"),
        (q * 2).alias("ocr_output_tokens_used"),
        F.col("l_linenumber").cast("bigint").alias("extraction_input_tokens_used"),
        F.col("l_suppkey").alias("extraction_output_tokens_used"),
        F.col("l_partkey").alias("summarization_input_tokens_used"),
        (F.col("l_partkey") % 7).alias("summarization_output_tokens_used"),
    )


# ---- event feeds ---------------------------------------------------------

EVENT_NAME = {
    "signup": E.QUEUED, "view": E.UPDATE, "click": E.UPDATE, "purchase": E.DONE, "error": E.FAILED,
}

# Payloads that are JSON but no record, records with text behind them, and odd ones that are fine.
ODD_PAYLOADS = {6: "5", 7: "[1]", 8: '{"a":1} x', 9: '{"a":1,"a":2}', 10: "null"}
_ODD_SQL = " ".join(f"WHEN event_id % 89 = {k} THEN '{v}'" for k, v in ODD_PAYLOADS.items())


def _odd_payloads(i: Column) -> Column:
    out = F.when(i % 89 == 5, F.substring("props", 1, 4))
    for k, v in ODD_PAYLOADS.items():
        out = out.when(i % 89 == k, v)
    return out


JOB_EVENTS = f"""job_events AS (
  SELECT user_id AS job_id, event_id AS seq,
         CASE WHEN event_id % 101 = 7 THEN 'parse_other' ELSE {_sql_case("event_type", EVENT_NAME)} END AS name,
         CASE WHEN event_id % 89 = 5 THEN substr(props, 1, 4)
              {_ODD_SQL}
              WHEN event_type = 'error' THEN '{{"error":"code ' || event_id || '"}}' ELSE props END AS payload
  FROM events)"""


def job_events(spark: SparkSession, sf_dir: str, job: Column | None = None) -> DataFrame:
    e = load(spark, sf_dir, "events")
    i = F.col("event_id")
    return e.select(
        (F.col("user_id") if job is None else job).alias("job_id"),
        i.alias("seq"),
        F.when(i % 101 == 7, "parse_other").otherwise(_case("event_type", EVENT_NAME)).alias("name"),
        _odd_payloads(i)
        .when(F.col("event_type") == "error", F.concat(F.lit('{"error":"code '), i.cast("string"), F.lit('"}')))
        .otherwise(F.col("props"))
        .alias("payload"),
    )


# Several lines per event; some events carry a comment, two data lines, a split
# data run or (rarely) a line without a colon.
LINES = """feed AS (
  SELECT user_id AS stream_id, event_id * 8 + k AS line_no, line
  FROM (SELECT user_id, event_id, unnest(range(8)) AS k,
               unnest([CASE WHEN event_id % 5 = 0 THEN ': keep-alive' END,
                       'event: ' || event_type,
                       'data: ' || props,
                       CASE WHEN event_id % 3 = 0 THEN 'data:  second ' || event_id END,
                       CASE WHEN event_id % 4 = 0 THEN 'id: ' || event_id WHEN event_id % 4 = 1 THEN 'other: x' END,
                       CASE WHEN event_id % 8 = 0 THEN 'data: late' || chr(13) END,
                       CASE WHEN event_id % 997 = 11 THEN 'no colon here' END,
                       '']) AS line
        FROM events)
  WHERE line IS NOT NULL)"""


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "props")
    i = F.col("event_id")
    text = i.cast("string")
    parts = F.array(
        F.when(i % 5 == 0, F.lit(": keep-alive")),
        F.concat(F.lit("event: "), F.col("event_type")),
        F.concat(F.lit("data: "), F.col("props")),
        F.when(i % 3 == 0, F.concat(F.lit("data:  second "), text)),
        F.when(i % 4 == 0, F.concat(F.lit("id: "), text)).when(i % 4 == 1, F.lit("other: x")),
        F.when(i % 8 == 0, F.lit("data: late\r")),
        F.when(i % 997 == 11, F.lit("no colon here")),
        F.lit(""),
    )
    return (
        spread(e).select("user_id", "event_id", F.posexplode(parts).alias("k", "line"))
        .where(F.col("line").isNotNull())
        .select(F.col("user_id").alias("stream_id"), (i * 8 + F.col("k")).alias("line_no"), "line")
    )


ENTITY_STATUS = {
    "signup": "pending", "click": "running", "error": "terminated", "view": "snapshotting", "purchase": "suspended",
}

STATUS_LOG = f"""status_log AS (
  SELECT user_id AS entity_id, event_id, user_id % 7 AS owner, epoch_us(ts) AS ts_us,
         {_sql_case("event_type", ENTITY_STATUS)} AS status
  FROM events)"""


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("entity_id"),
        "event_id",
        (F.col("user_id") % 7).alias("owner"),
        micros("ts").alias("ts_us"),
        _case("event_type", ENTITY_STATUS).alias("status"),
    )


RUN_OUTPUT = """run_output AS (
  SELECT conv_id AS run_id, turn AS seq,
         CASE WHEN turn >= 5 THEN 'eof' WHEN role = 'system' THEN 'heartbeat' ELSE 'output' END AS name,
         conv_id % 17 = 3 AND turn = 3 AS bad,
         CASE WHEN role = 'assistant' THEN 'stdout' ELSE 'stderr' END AS stream, text AS line
  FROM conversations)"""


def run_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "conversations")
    turn = F.col("turn")
    stream = F.when(F.col("role") == "assistant", "stdout").otherwise("stderr")
    body = F.to_json(F.struct(F.col("text").alias("line"), turn.alias("timestamp"), stream.alias("stream")))
    return c.select(
        F.col("conv_id").alias("run_id"),
        turn.alias("seq"),
        F.when(turn >= 5, E.EOF).when(F.col("role") == "system", "heartbeat").otherwise(E.OUTPUT).alias("name"),
        F.when((F.col("conv_id") % 17 == 3) & (turn == 3), F.lit("oops")).otherwise(body).alias("payload"),
    )


def captured_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").alias("run_id"),
        F.col("turn").alias("seq"),
        F.col("text").alias("line"),
        F.when(F.col("role") == "assistant", "stdout").otherwise("stderr").alias("stream"),
    )


LATENCY = """runs AS (
  SELECT l_linenumber AS level, l_suppkey % 5 AS repeat_no,
         CAST(floor(l_extendedprice * 1000) AS BIGINT) AS ns,
         CASE WHEN l_returnflag = 'R' OR l_linenumber = 7 AND l_suppkey % 5 = 4 THEN 'timed out' END AS error,
         l_orderkey * 1000000 AS started_ns
  FROM lineitem)"""


def latency_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    lost = (F.col("l_returnflag") == "R") | ((F.col("l_linenumber") == 7) & (F.col("l_suppkey") % 5 == 4))
    return li.select(
        F.col("l_linenumber").alias("level"),
        (F.col("l_suppkey") % 5).alias("repeat_no"),
        F.floor(F.col("l_extendedprice") * 1000).cast("bigint").alias("ns"),
        F.when(lost, "timed out").alias("error"),
        (F.col("l_orderkey") * 1000000).alias("started_ns"),
    ).withColumn("ended_ns", F.col("started_ns") + F.col("ns"))


# ---- tables --------------------------------------------------------------

TABLE_ROWS = """table_rows AS (
  SELECT doc_id, CAST((n - 1) // 3 + 1 AS BIGINT) AS page_number, n AS row_no, cells
  FROM (SELECT l_orderkey AS doc_id,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity,
                                  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS n,
               CASE WHEN l_orderkey % 3 = 0 AND l_tax > 0.05
                    THEN [CAST(l_partkey AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), l_returnflag || '&' || l_linestatus, '<tax>']
                    ELSE [CAST(l_partkey AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), l_returnflag || '&' || l_linestatus]
               END AS cells
        FROM lineitem))"""


def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docspark.operators.hotkeys import numbered

    li = load(spark, sf_dir, "lineitem")
    ties = ["l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus", "l_shipdate"]
    base = [
        F.col("l_partkey").cast("string"),
        F.col("l_quantity").cast("bigint").cast("string"),
        F.concat("l_returnflag", F.lit("&"), "l_linestatus"),
    ]
    wide = (F.col("l_orderkey") % 3 == 0) & (F.col("l_tax") > 0.05)
    n = numbered(li, ["l_orderkey"], "l_partkey", "row_no", ties)
    return n.select(
        F.col("l_orderkey").alias("doc_id"),
        F.expr("(row_no - 1) div 3 + 1").alias("page_number"),
        "row_no",
        F.when(wide, F.array(*base, F.lit("<tax>"))).otherwise(F.array(*base)).alias("cells"),
    )
