"""Request validation: accepted rows and a reject table with error codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions import scalars as S
from docspark.schemas import MIME_TYPES

# Messages of the local checks.
NO_SOURCE = "exactly one of file_id, file_url, or raw_text must be provided"
NO_SCHEMA = "at least one structured_extraction_options must be provided"
NO_CLASSES = "at least one page_classifications must be provided"

CHECKS = (
    ("source", "INVALID_FILE", NO_SOURCE),
    ("schemas", "INVALID_CONFIGURATION", NO_SCHEMA),
    ("classes", "INVALID_PAGE_CLASSIFICATION", NO_CLASSES),
    ("page_range", "INVALID_PAGE_RANGE", "page range is malformed"),
    ("mime_type", "INVALID_MIME_TYPE", "mime type is not supported"),
    ("schema", "INVALID_JSON_SCHEMA", "schema is not a JSON object"),
    ("dataset_name", "INVALID_DATASET_NAME", "dataset name has other characters than letters, digits, - and _"),
)


def _failures(columns: list[str]) -> dict[str, Column]:
    """Failure predicate of each check whose columns are present."""
    kind = F.col("job_type") if "job_type" in columns else F.lit("")
    given = {
        "source": lambda: ~S.source_provided("file_id", "file_url", "raw_text"),
        "schemas": lambda: (kind == "extract") & (F.coalesce(F.col("schema_count"), F.lit(0)) < 1),
        "classes": lambda: (kind == "classify") & (F.coalesce(F.col("class_count"), F.lit(0)) < 1),
        "page_range": lambda: F.coalesce(F.col("page_range") != "", F.lit(False)) & ~S.page_range_valid("page_range"),
        "mime_type": lambda: F.coalesce(F.col("mime_type") != "", F.lit(False)) & ~F.col("mime_type").isin(*MIME_TYPES),
        "schema": lambda: F.col("json_schema").isNotNull()
        & ~F.coalesce(F.schema_of_variant(F.try_parse_json("json_schema")).startswith("OBJECT"), F.lit(False)),
        "dataset_name": lambda: F.col("dataset_name").isNotNull() & ~S.valid_dataset_name("dataset_name"),
    }
    needs = {
        "source": "raw_text", "schemas": "schema_count", "classes": "class_count", "page_range": "page_range",
        "mime_type": "mime_type", "schema": "json_schema", "dataset_name": "dataset_name",
    }
    return {name: make() for name, make in given.items() if needs[name] in columns}


def with_verdict(requests: DataFrame) -> DataFrame:
    """Add ``code`` and ``message`` of the first failed check (NULL when fine)."""
    failed = _failures(requests.columns)
    code, message = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, error, text in reversed(CHECKS):
        if name in failed:
            code = F.when(failed[name], F.lit(error)).otherwise(code)
            message = F.when(failed[name], F.lit(text)).otherwise(message)
    return requests.withColumn("code", code).withColumn("message", message)


def validate(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Row-local checks; one scan, no shuffle."""
    judged = with_verdict(requests)
    return (
        judged.where(F.col("code").isNull()).drop("code", "message"),
        judged.where(F.col("code").isNotNull()),
    )


def check_known(requests: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Requests whose id exists; the others get ``ENTITY_NOT_FOUND``.

    An absent id is not checked.
    """
    ids = known.select(key).distinct().withColumn("_known", F.lit(True))
    judged = requests.join(ids, key, "left").withColumn(
        "_ok", F.col(key).isNull() | F.coalesce("_known", F.lit(False))
    )
    ok = judged.where("_ok").drop("_ok", "_known")
    rejects = judged.where(~F.col("_ok")).drop("_ok", "_known").withColumn("code", F.lit("ENTITY_NOT_FOUND"))
    return ok, rejects
