"""Registered queries over the driver tables, each with its DuckDB oracle."""

from docspark.workload.registry import ORACLES, QUERIES


def _load() -> None:
    from docspark.workload import (  # noqa: F401
        q_aggregates,
        q_catalog,
        q_documents,
        q_events,
        q_jobs,
        q_scalars,
        q_sources,
    )


def queries():
    _load()
    return dict(QUERIES)


def oracles():
    _load()
    return dict(ORACLES)
