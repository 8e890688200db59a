"""Incremental ingest: new documents flow through a dataset's configuration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from docspark.plans import jobs
from docspark.plans.config import Configuration
from docspark.sources.results import write_results
from docspark.streaming.feeds import start


def stream_dataset(
    docs: DataFrame,
    config: Configuration,
    sink: str,
    checkpoint: str,
    job_type: str = "dataset",
    key: str = "doc_id",
    on_done: Callable[[SparkSession, str, int], None] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Run a dataset job over a stream of documents.

    The job is row-local, so a trigger has no shuffle and no state.  Each
    micro-batch writes its own folder; ``on_done`` hears of it afterwards.
    """
    results = jobs.assemble(jobs.run_dataset(docs, config, job_type, key), key)

    def each(batch: DataFrame, batch_id: int) -> None:
        path = f"{sink}/batch_id={batch_id}"
        write_results(batch, path, "overwrite")
        if on_done is not None:
            on_done(batch.sparkSession, path, batch_id)

    return start(results, each, checkpoint, "append", interval)
