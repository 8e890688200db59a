"""Status logs of long-lived entities: time to state, audits, deadlines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.operators import hotkeys

# The documented life cycle.
LIFE_CYCLE = (
    ("pending", "running"),
    ("pending", "terminated"),
    ("running", "snapshotting"),
    ("snapshotting", "running"),
    ("running", "suspending"),
    ("running", "suspended"),
    ("suspending", "suspended"),
    ("suspended", "running"),
    ("suspended", "terminated"),
    ("running", "terminated"),
)


def _first(status: str, ts: str) -> Column:
    return F.min(F.when(F.col("status") == status, F.col(ts)))


ENDED_EARLY = "sandbox terminated unexpectedly"
NEVER_READY = "timed out waiting for running"


def time_to_state(log: DataFrame, ts: str = "ts_us") -> DataFrame:
    """Per entity: the waits from the first request to pending and to running (integer time unit).

    An entity that runs at once was never pending and waits nothing more.  One
    that ends first, or never runs, has no waits but an ``error``; statistics
    leave it out.  Only minima are needed, so the log collapses before the
    shuffle.
    """
    firsts = log.groupBy("entity_id").agg(
        F.min(ts).alias("requested"), _first("pending", ts).alias("pending"), _first("running", ts).alias("running"),
        _first("terminated", ts).alias("ended"),
    )
    running = F.col("running")
    # Created: when it is first seen pending or running.
    made = F.least("pending", "running")
    error = F.when(F.col("ended").isNotNull() & (running.isNull() | (F.col("ended") < running)), ENDED_EARLY).when(
        running.isNull(), NEVER_READY)
    return firsts.withColumn("error", error).select(
        "entity_id",
        F.when(F.col("error").isNull(), made - F.col("requested")).alias("create_wait"),
        F.when(F.col("error").isNull(), running - made).alias("pending_wait"),
        F.when(F.col("error").isNull(), running - F.col("requested")).alias("ready_wait"),
        "error",
    )


def transitions(log: DataFrame, ts: str = "ts_us", ties=(), **limits: int) -> DataFrame:
    """Each log row with the status before it."""
    return hotkeys.previous_row(log, ["entity_id"], ts, {"prev_status": "status"}, ties, **limits)


def audit_transitions(
    log: DataFrame, allowed: Iterable[tuple[str, str]] = LIFE_CYCLE, ts: str = "ts_us", ties=(), **limits: int
) -> DataFrame:
    """Rows whose step is not part of the life cycle."""
    steps = transitions(log, ts, ties, **limits).where(
        F.col("prev_status").isNotNull() & (F.col("prev_status") != F.col("status"))
    )
    pairs = [f"{a}>{b}" for a, b in allowed]
    return steps.where(~F.concat_ws(">", "prev_status", "status").isin(pairs))


def await_status(log: DataFrame, want: str, max_wait: int, ts: str = "ts_us") -> DataFrame:
    """Outcome of waiting for a status with a deadline.

    ``ready`` when it comes first, ``terminated`` when the entity ends before
    it, ``timed_out`` otherwise.  The wait starts with the first log row.
    """
    firsts = log.groupBy("entity_id").agg(
        F.min(ts).alias("start"), _first(want, ts).alias("got"), _first("terminated", ts).alias("ended")
    )
    deadline = F.col("start") + F.lit(max_wait)
    got = F.when(F.col("got") < deadline, F.col("got"))
    ended = F.when(F.col("ended") < deadline, F.col("ended"))
    ready = got.isNotNull() & (ended.isNull() | (got < ended))
    outcome = F.when(ready, "ready").when(ended.isNotNull(), "terminated").otherwise("timed_out")
    return firsts.select(
        "entity_id", outcome.alias("outcome"), F.when(ready, F.col("got") - F.col("start")).alias("waited")
    )


def latest_entities(log: DataFrame, order: str = "ts_us") -> DataFrame:
    """Current row per entity; ``max_by`` collapses before the shuffle."""
    others = [c for c in log.columns if c != "entity_id"]
    row = F.struct(*[F.col(c) for c in others])
    return log.groupBy("entity_id").agg(F.max_by(row, order).alias("_r")).select("entity_id", "_r.*")


def list_entities(log: DataFrame, owner=None, status=None, order: str = "ts_us") -> DataFrame:
    """Recorded entities in their current state, filtered by owner and status.

    The owner never changes, so that filter goes before the aggregate.
    """
    if owner is not None:
        log = log.where(F.col("owner") == owner)
    now = latest_entities(log, order)
    return now if status is None else now.where(F.col("status") == status)
