"""Job and usage analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.schemas import USAGE_COUNTERS

SETTLED = ("pending", "failure", "successful")


def dataset_analytics(jobs: DataFrame, by: str = "dataset_id") -> DataFrame:
    """Jobs per state.  Every intermediate status counts as processing, so the
    four states add up to the total."""
    status = F.col("status")
    return jobs.groupBy(by).agg(
        F.count_if(~status.isin(*SETTLED)).alias("total_processing_parse_jobs"),
        F.count_if(status == "pending").alias("total_pending_parse_jobs"),
        F.count_if(status == "failure").alias("total_error_parse_jobs"),
        F.count_if(status == "successful").alias("total_successful_parse_jobs"),
        F.count(F.lit(1)).alias("total_jobs"),
    )


def job_usage(usage: DataFrame, jobs: DataFrame) -> DataFrame:
    """One usage row per successful job.

    Usage is added up per job before the join, so both sides are unique on
    ``parse_id`` and no job can be a hot join key.
    """
    per_job = usage.groupBy("parse_id").agg(*[F.sum(c).cast("bigint").alias(c) for c in USAGE_COUNTERS])
    done = jobs.where(F.col("status") == "successful").select("parse_id", "dataset_id", "job_type")
    return per_job.join(done, "parse_id")


def usage_summary(usage: DataFrame, jobs: DataFrame) -> DataFrame:
    """Usage per (dataset, job type), per dataset, and overall.

    Rolled up from the finest totals, so the raw rows are shuffled once.
    """
    fine = job_usage(usage, jobs).groupBy("dataset_id", "job_type").agg(
        F.count(F.lit(1)).alias("jobs"), *[F.sum(c).alias(c) for c in USAGE_COUNTERS]
    )
    return fine.rollup("dataset_id", "job_type").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("jobs").alias("jobs"),
        *[F.sum(c).alias(c) for c in USAGE_COUNTERS],
    )


def meter(fragments: DataFrame, key: str = "doc_id") -> DataFrame:
    """Pages parsed, pages with a signature, pages with strikethrough text.

    Fragments collapse to one row per page before the pages are counted.
    """
    kind = F.col("fragment_type")
    per_page = fragments.groupBy(key, "page_number").agg(
        F.bool_or(kind == "signature").alias("signed"), F.bool_or(kind == "strikethrough").alias("struck")
    )
    return per_page.groupBy(key).agg(
        F.count(F.lit(1)).alias("pages_parsed"),
        F.count_if("signed").alias("signature_detected_pages"),
        F.count_if("struck").alias("strikethrough_detected_pages"),
    )


def progress(jobs: DataFrame, tasks: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Tasks done / total per job; a job without tasks keeps NULL counts, not zero.

    With ``pages`` (``parse_id, parsed``), pages parsed / total alike.
    """
    per_job = tasks.groupBy("parse_id").agg(
        F.count_if("done").alias("tasks_completed_count"), F.count(F.lit(1)).alias("tasks_total_count")
    )
    share = F.try_divide(F.col("tasks_completed_count"), F.col("tasks_total_count"))
    out = jobs.select("parse_id").join(per_job, "parse_id", "left").withColumn("share_done", share)
    if pages is None:
        return out
    counted = pages.groupBy("parse_id").agg(
        F.count_if("parsed").alias("parsed_pages_count"), F.count(F.lit(1)).alias("total_pages")
    )
    return out.join(counted, "parse_id", "left")
