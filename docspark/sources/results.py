"""Parse results: reading nested JSON, writing partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions import scalars as S
from docspark.operators.events import feed_state, valid_json
from docspark.schemas import PARSE_RESULT_JSON

# Fixed value: the text of an error.
BAD_REPLY = "failed to decode SSE response"
# What a reject says whose line is no result.
BAD_RESULT = "the line is not a parse result"


def shape_result(df: DataFrame) -> DataFrame:
    """Typed form of decoded results: timestamps, page lists, page-keyed reasons.

    Blank optional text becomes NULL; absent counts stay NULL, not zero.
    """
    data = F.transform(
        "structured_data",
        lambda s: F.struct(
            s["data"].alias("data"),
            S.union_values(s["page_numbers"]).alias("page_numbers"),
            s["schema_name"].alias("schema_name"),
        ),
    )
    classes = F.transform(
        "page_classes",
        lambda c: F.struct(
            c["page_class"].alias("page_class"),
            c["page_numbers"].alias("page_numbers"),
            F.transform_keys(c["classification_reasons"], lambda k, _: k.cast("int")).alias("classification_reasons"),
        ),
    )
    out = df.withColumn("structured_data", data).withColumn("page_classes", classes)
    for c in ("created_at", "finished_at"):
        out = out.withColumn(c, S.ts_rfc3339(c))
    for c in ("error", "message_update", "dataset_id", "pdf_base64"):
        out = out.withColumn(c, S.blank_to_null(c))
    return out


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result files, one JSON object per line, with the fixed schema (no inference)."""
    return shape_result(spark.read.schema(PARSE_RESULT_JSON).json(path))


def decode_results(df: DataFrame, column: str) -> DataFrame:
    """The same from a JSON text column; undecodable rows have ``parse_id`` NULL."""
    return shape_result(df.select(F.from_json(column, PARSE_RESULT_JSON).alias("r")).select("r.*"))


def decode_with_rejects(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Results, and the rows that are none as rejects ``(line, code, message)`` with their text.

    A reject is no JSON object, or has a field of another type than the result's.
    Every row is in one of the two tables; rows are read once for each.
    """
    schema = f"{PARSE_RESULT_JSON}, _corrupt STRING"
    # The option keeps the whole schema in use, so that a field not asked for is checked too.
    read = F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = S.with_once(df.select(F.col(column).alias("line")), "r", read)
    bad = F.col("r").isNull() | F.col("r._corrupt").isNotNull() | ~F.coalesce(S.trimmed("line").startswith("{"), F.lit(False))
    results = shape_result(parsed.where(~bad).select("r.*").drop("_corrupt"))
    rejects = parsed.where(bad).select("line", F.lit("INVALID_RESULT").alias("code"), F.lit(BAD_RESULT).alias("message"))
    return results, rejects


def read_results_with_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The same from result files, one JSON object per line; blank lines are no rows."""
    lines = spark.read.text(path)
    return decode_with_rejects(lines.where(S.trimmed("value") != ""), "value")


def read_replies(replies: DataFrame) -> DataFrame:
    """Replies that are either an event feed or one plain JSON result.

    ``(stream_id, content_type, line_no, line)``: feeds are framed and reduced
    to their first outcome, plain replies are decoded as they are.  Every reply
    gives one row; ``reply_status`` and ``reply_error`` say how it went, and only
    successful ones have a result.  The lines of one plain reply are joined in
    one value, so such a reply is bounded by the size of a value.
    """
    is_feed = F.coalesce(F.col("content_type").contains("text/event-stream"), F.lit(False))
    from_feed = feed_state(replies.where(is_feed).select("stream_id", "line_no", "line")).select(
        "stream_id", F.col("result").alias("body"), F.col("status").alias("reply_status"), F.col("error").alias("reply_error")
    )
    plain = replies.where(~is_feed).groupBy("stream_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n"
        ).alias("body")
    )
    readable = valid_json("body")
    judged = plain.select(
        "stream_id",
        F.when(readable, F.col("body")).alias("body"),
        F.when(readable, "successful").otherwise("error").alias("reply_status"),
        F.when(~readable, F.lit(BAD_REPLY)).alias("reply_error"),
    )
    both = from_feed.unionByName(judged)
    decoded = both.select("stream_id", "reply_status", "reply_error", F.from_json("body", PARSE_RESULT_JSON).alias("r"))
    return shape_result(decoded.select("stream_id", "reply_status", "reply_error", "r.*"))


def write_results(df: DataFrame, path: str, mode: str = "append") -> None:
    """Results partitioned by job type, so that listings prune by it."""
    df.write.mode(mode).partitionBy("job_type").parquet(path)
