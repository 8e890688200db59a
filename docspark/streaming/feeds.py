"""Event feeds as streams.

Outcomes that are aggregates in batch stay native streaming aggregates, with
partial aggregation in front of the shuffle, so a hot job does not slow a
trigger down.  Feeds whose rows are kept run the batch operator on each
micro-batch and remember closed feeds in a table next to the sink.  Every
micro-batch writes its own folder in overwrite mode, so a repeated one after a
failure replaces its first attempt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docspark.operators import events as E
from docspark.schemas import OUTPUT_EVENT, PARSE_EVENT
from docspark.session import shared_dir

STATUS_EVENT = "entity_id BIGINT, event_id BIGINT, owner BIGINT, ts_us BIGINT, status STRING"


def stage(df: DataFrame, name: str, path: str | None = None) -> str:
    """Write rows as files of a stream source (appending to an existing one)."""
    path = path or f"{shared_dir(df.sparkSession)}-{name}"
    df.write.mode("append").parquet(path)
    return path


def read_feed(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """A feed of files, from the earliest one on."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(path)


def to_end(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process what is there, then stop."""
    start(df, each, checkpoint, mode).awaitTermination()


def start(
    df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    interval: str | None = None,
) -> StreamingQuery:
    """Start a stream; without an interval it ends when the input is used up."""
    writer = df.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def _batch_writer(sink: str) -> Callable[[DataFrame, int], None]:
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return each


def _latest(spark: SparkSession, sink: str, key: str) -> DataFrame:
    """Last emitted row per key of an update-mode sink."""
    log = spark.read.parquet(sink)
    row = F.struct(*[F.col(c) for c in log.columns if c not in (key, "batch_id")])
    return log.groupBy(key).agg(F.max_by(row, "batch_id").alias("_r")).select(key, "_r.*")


# ---- job state -----------------------------------------------------------


def job_state_reduced(events: DataFrame) -> DataFrame:
    """Reduced state per job, for update mode.  Independent of arrival order."""
    return E.judged(events).groupBy("job_id").agg(*E.job_state_aggregates())


def run_job_state(spark: SparkSession, path: str, ended: bool = True, files_per_trigger: int | None = None) -> DataFrame:
    """Stream a feed to its end; ``ended`` turns open jobs into errors."""
    work = shared_dir(spark)
    feed = read_feed(spark, path, PARSE_EVENT, files_per_trigger)
    to_end(job_state_reduced(feed), _batch_writer(f"{work}/state"), f"{work}/checkpoint", "update")
    return _latest(spark, f"{work}/state", "job_id").select("job_id", *E.job_outcome(ended))


JOB_STATE = "stop_seq BIGINT, kind STRING, name STRING, payload STRING, events BIGINT, last_seq BIGINT, last_name STRING"
# Mark in ``kind`` of a job whose outcome is out already.
CLOSED = "closed"
JOB_OUT = "job_id BIGINT, status STRING, error STRING, result STRING"


def _merge(state: tuple, pdf: pd.DataFrame) -> tuple:
    """Fold one Arrow batch into the state: earliest stop row, count, last row."""
    stop_seq, kind, name, payload, n, last_seq, last_name = state
    stops = pdf[pdf["kind"] != "go"]
    if len(stops):
        r = stops.loc[stops["seq"].idxmin()]
        if stop_seq is None or r["seq"] < stop_seq:
            stop_seq, kind, name, payload = int(r["seq"]), r["kind"], r["name"], r["payload"]
    tail = pdf.loc[pdf["seq"].idxmax()]
    if last_seq is None or tail["seq"] > last_seq:
        last_seq, last_name = int(tail["seq"]), tail["name"]
    return (stop_seq, kind, name, payload, n + len(pdf), last_seq, last_name)


def job_state_with_timeout(events: DataFrame, ts: str, delay: str, timeout_ms: int) -> DataFrame:
    """One row per job, on its end or when event time passes its last event by
    ``timeout_ms``: the streaming form of a feed that ends without an outcome.

    The first outcome stands: an ended job leaves a mark until its timeout, and
    rows that come meanwhile are dropped; rows older than the watermark never
    arrive.  The state is seven values and batches are folded as they come, so
    memory does not depend on the size of a job.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else (None, None, None, None, 0, None, None)
        closed = now[1] == CLOSED
        if state.hasTimedOut:
            state.remove()
            if not closed:
                yield _closing_row(key[0], now)
            return
        newest = 0
        for pdf in batches:
            now = now if closed else _merge(now, pdf)
            newest = max(newest, int(pdf["ts_ms"].max()))
        if not closed and now[0] is not None:
            yield _closing_row(key[0], now)
            now = (now[0], CLOSED, None, None, now[4], None, None)
        state.update(now)
        state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + timeout_ms)

    timed = (
        E.judged(events.withWatermark(ts, delay))
        .withColumn("ts_ms", F.unix_millis(ts))
        .select("job_id", "seq", "name", "payload", "kind", "ts_ms", ts)
    )
    out = timed.groupBy("job_id").applyInPandasWithState(
        step,
        "job_id BIGINT, kind STRING, name STRING, payload STRING, events BIGINT, last_name STRING",
        JOB_STATE,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    shaped = out.select(
        "job_id",
        F.when(F.col("kind").isNotNull(), F.struct("kind", "name", "payload", F.lit(None).cast("string").alias("error"))).alias("_stop"),
        F.col("events").alias("_events"),
        F.struct(F.col("last_name").alias("name")).alias("_last"),
    )
    return shaped.select("job_id", *E.job_outcome(True))


def _closing_row(job_id, state: tuple) -> pd.DataFrame:
    _, kind, name, payload, n, _, last_name = state
    row = {"job_id": job_id, "kind": kind, "name": name, "payload": payload, "events": n, "last_name": last_name}
    return pd.DataFrame([row])


# ---- feeds that stop -----------------------------------------------------


# A closed feed is remembered until it has sent nothing for so many micro-batches.
KEEP_CLOSED = 1000


def _until_closed(
    sink: str, key: str, rows: Callable[[DataFrame], DataFrame], closed: Callable[[DataFrame], DataFrame],
    notify: Callable[[DataFrame, int], None] | None = None, keep: int = KEEP_CLOSED,
) -> Callable[[DataFrame, int], None]:
    """Micro-batch step: skip feeds closed earlier, keep rows, carry the marks of closed feeds on.

    Marks (key, last micro-batch with a row of the feed) live in two folders in
    turn: a micro-batch reads those of the one before and overwrites those of the
    one before that, which no repetition needs.  A mark leaves once its feed was
    silent for ``keep`` micro-batches, so marks do not grow with the stream's age;
    rows that come later still begin a new feed.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark, fresh, now = batch.sparkSession, batch, F.lit(batch_id).cast("bigint")
        marks = None
        if batch_id > 0:
            marks = spark.read.schema(f"{key} BIGINT, seen BIGINT").parquet(f"{sink}/closed/{(batch_id - 1) % 2}")
            fresh = batch.join(marks, key, "left_anti")
        rows(fresh).write.mode("overwrite").parquet(f"{sink}/rows/batch_id={batch_id}")
        kept = closed(fresh).select(key).distinct().withColumn("seen", now)
        if marks is not None:
            heard = batch.select(key).distinct().withColumn("_now", now)
            held = marks.join(heard, key, "left").select(key, F.coalesce("_now", "seen").alias("seen"))
            kept = kept.unionByName(held.where(F.col("seen") > batch_id - keep))
        kept.write.mode("overwrite").parquet(f"{sink}/closed/{batch_id % 2}")
        if notify is not None:
            notify(spark.read.parquet(f"{sink}/rows/batch_id={batch_id}"), batch_id)

    return each


def closed_runs(events: DataFrame) -> DataFrame:
    bad = (F.col("name") == E.OUTPUT) & ~E.valid_json("payload")
    return events.where((F.col("name") == E.EOF) | bad)


def follow_to(
    events: DataFrame, sink: str, checkpoint: str, interval: str | None = None, keep: int = KEEP_CLOSED,
) -> StreamingQuery:
    """Follow output feeds into a sink; rows after a run's end never arrive there."""
    step = _until_closed(sink, "run_id", E.follow_output, closed_runs, keep=keep)
    return start(events, step, checkpoint, "append", interval)


def run_follow_output(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    work = shared_dir(spark)
    feed = read_feed(spark, path, OUTPUT_EVENT, files_per_trigger)
    follow_to(feed, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/out/rows")


def replay_then_live(spark: SparkSession, path: str, live: DataFrame) -> DataFrame:
    """Rows captured before the stream starts, then rows that arrive later.

    The second run continues from the checkpoint of the first.
    """
    work = shared_dir(spark)
    copy = _batch_writer(f"{work}/out")
    to_end(read_feed(spark, path, OUTPUT_EVENT), copy, f"{work}/checkpoint")
    stage(live, "live", path)
    to_end(read_feed(spark, path, OUTPUT_EVENT), copy, f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out")


def updates_to(
    events: DataFrame, sink: str, checkpoint: str, on_update: Callable[[DataFrame, int], None],
    interval: str | None = None,
) -> StreamingQuery:
    """Call ``on_update(rows, batch_id)`` with each micro-batch of update rows.

    The rows end with the terminal event of their job.
    """
    def ends(batch: DataFrame) -> DataFrame:
        return E.judged(batch).where(F.col("kind") != "go")

    step = _until_closed(sink, "job_id", E.job_updates, ends, on_update)
    return start(events, step, checkpoint, "append", interval)


# ---- deadlines -----------------------------------------------------------


def await_reduced(log: DataFrame, want: str) -> DataFrame:
    """Earliest times that decide a wait; a native aggregate in update mode."""
    def first(status: str, name: str):
        return F.min(F.when(F.col("status") == status, F.col("ts_us"))).alias(name)

    return log.groupBy("entity_id").agg(
        F.min("ts_us").alias("start"), first(want, "got"), first("terminated", "ended"), F.max("ts_us").alias("seen")
    )


def run_await_status(spark: SparkSession, path: str, want: str, max_wait: int, files_per_trigger: int | None = None) -> DataFrame:
    work = shared_dir(spark)
    feed = read_feed(spark, path, STATUS_EVENT, files_per_trigger)
    to_end(await_reduced(feed, want), _batch_writer(f"{work}/state"), f"{work}/checkpoint", "update")
    r = _latest(spark, f"{work}/state", "entity_id")
    limit = F.col("start") + max_wait
    ready = (F.col("got") < limit) & (F.col("ended").isNull() | (F.col("got") < F.col("ended")))
    outcome = (
        F.when(F.coalesce(ready, F.lit(False)), "ready")
        .when(F.coalesce(F.col("ended") < limit, F.lit(False)), "terminated")
        .otherwise("timed_out")
    )
    return r.select("entity_id", outcome.alias("outcome"))


WAIT_STATE = "start BIGINT, got BIGINT, ended BIGINT, last_ms BIGINT, decided BOOLEAN"
WAIT_OUT = "entity_id BIGINT, outcome STRING, waited BIGINT"


def await_with_deadline(
    log: DataFrame, want: str, max_wait: int, delay: str = "0 seconds", keep_ms: int = 24 * 3600 * 1000,
) -> DataFrame:
    """One row per entity as soon as its wait is decided, ``timed_out`` without a further row of it too.

    The rule is that of ``status.await_status``.  Event time decides: an outcome
    leaves once the watermark has passed the row that decides it, or the
    deadline, so rows may come in any order within ``delay``.  Rows without an
    entity are heartbeats, which only move event time on; rows without a time, or
    of 1970 and before, are dropped.  A decided entity leaves a mark until event time passes its last row
    by ``keep_ms``; rows that come later still begin a new wait.  The state is
    five values, folded batch by batch, whatever an entity's rows.
    """

    def outcome(key: int, start: int, got: int | None, ended: int | None) -> pd.DataFrame:
        got, ended = (x if x is not None and x < start + max_wait else None for x in (got, ended))
        ready = got is not None and (ended is None or got < ended)
        name = "ready" if ready else "timed_out" if ended is None else "terminated"
        waited = pd.array([got - start if ready else None], "Int64")
        return pd.DataFrame({"entity_id": [key], "outcome": [name], "waited": waited})

    def least(held: int | None, times: pd.Series) -> int | None:
        return held if not len(times) else int(times.min()) if held is None else min(held, int(times.min()))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        fresh, watermark = (None, None, None, 0, False), state.getCurrentWatermarkMs()
        start, got, ended, last_ms, decided = state.get if state.exists else fresh
        if decided and last_ms + keep_ms < watermark:  # the mark leaves before rows that come with the timer
            start, got, ended, last_ms, decided = fresh
        for pdf in batches:
            if not len(pdf):  # a call by the timer
                continue
            times, status = pdf["ts_us"], pdf["status"]
            last_ms = max(last_ms, int(times.max()) // 1000)
            if not decided:
                start = least(start, times)
                got, ended = least(got, times[status == want]), least(ended, times[status == "terminated"])
        if key[0] is None or pd.isna(key[0]):
            return
        if start is None:
            state.remove()
            return
        if not decided:
            due = min(x for x in (start + max_wait, got, ended) if x is not None) // 1000
            decided = due < watermark
            if decided:
                yield outcome(key[0], start, got, ended)
        due = last_ms + keep_ms if decided else due
        state.update((start, got, ended, last_ms, decided))
        state.setTimeoutTimestamp(max(due, watermark))

    timed = log.where(F.col("ts_us").isNotNull()).withColumn("ts", F.timestamp_micros("ts_us")).withWatermark("ts", delay)
    return timed.select("entity_id", "ts_us", "status", "ts").groupBy("entity_id").applyInPandasWithState(
        step, WAIT_OUT, WAIT_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def run_await_deadline(
    spark: SparkSession, path: str, want: str, max_wait: int, delay: str = "0 seconds", files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream a log to its end; waits whose deadline event time has not passed have no row yet."""
    work = shared_dir(spark)
    feed = read_feed(spark, path, STATUS_EVENT, files_per_trigger)
    to_end(await_with_deadline(feed, want, max_wait, delay), _batch_writer(f"{work}/out"), f"{work}/checkpoint")
    return spark.read.schema(WAIT_OUT).parquet(f"{work}/out").drop("batch_id")
