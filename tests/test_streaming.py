"""Streams end in the same state as the batch operators."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from docspark.operators import events as E
from docspark.operators import status as ST
from docspark.plans.config import Configuration, ParsingOptions
from docspark.streaming import feeds, ingest
from test_events import FEEDS, RUNS, events


@pytest.fixture
def job_events(spark):
    return events(spark, FEEDS)


def staged(df, tmp_path, files=1):
    path = str(tmp_path / "feed")
    df.repartition(files).write.parquet(path)
    return path


@pytest.mark.parametrize("files", [1, 4])
def test_job_state_equals_batch(spark, tmp_path, job_events, files):
    path = staged(job_events, tmp_path, files)
    got = feeds.run_job_state(spark, path, files_per_trigger=1)
    assert sorted(got.collect(), key=str) == sorted(E.job_state(job_events).collect(), key=str)


def test_open_jobs_are_processing_while_the_stream_lives(spark, tmp_path, job_events):
    got = {r["job_id"]: r for r in feeds.run_job_state(spark, staged(job_events, tmp_path), ended=False).collect()}
    assert (got[4]["status"], got[4]["error"]) == ("processing", None)
    assert got[1]["status"] == "successful"


def test_follow_equals_batch(spark, tmp_path):
    runs = events(spark, RUNS).withColumnRenamed("job_id", "run_id")
    want = E.follow_output(runs).collect()
    got = feeds.run_follow_output(spark, staged(runs, tmp_path)).select("run_id", "seq", "line", "timestamp", "stream", "error")
    assert sorted(got.collect(), key=str) == sorted(want, key=str)


def test_closed_runs_stay_closed_in_later_batches(spark, tmp_path):
    runs = events(spark, RUNS).withColumnRenamed("job_id", "run_id")
    path, sink, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    late = runs.where("seq >= 2 and not (run_id = 1 and seq = 2)")
    runs.join(late, ["run_id", "seq"], "left_anti").coalesce(1).write.parquet(path)
    feeds.follow_to(feeds.read_feed(spark, path, feeds.OUTPUT_EVENT), sink, cp).awaitTermination()
    late.coalesce(1).write.mode("append").parquet(path)
    feeds.follow_to(feeds.read_feed(spark, path, feeds.OUTPUT_EVENT), sink, cp).awaitTermination()
    got = spark.read.parquet(f"{sink}/rows").select("run_id", "seq", "line", "timestamp", "stream", "error")
    assert sorted(got.drop("batch_id").collect(), key=str) == sorted(E.follow_output(runs).collect(), key=str)


def test_update_callback(spark, tmp_path, job_events):
    seen = []

    def on_update(rows, batch_id):
        seen.extend((r["job_id"], r["seq"]) for r in rows.collect())

    feed = feeds.read_feed(spark, staged(job_events, tmp_path), feeds.PARSE_EVENT)
    feeds.updates_to(feed, str(tmp_path / "out"), str(tmp_path / "cp"), on_update).awaitTermination()
    assert sorted(seen) == sorted((r["job_id"], r["seq"]) for r in E.job_updates(job_events).collect())


def test_replay_then_live(spark, tmp_path):
    runs = events(spark, RUNS).withColumnRenamed("job_id", "run_id")
    path = staged(runs.where("seq < 1"), tmp_path)
    got = feeds.replay_then_live(spark, path, runs.where("seq >= 1"))
    assert got.count() == runs.count()
    assert {r["batch_id"] for r in got.select("batch_id").distinct().collect()} == {0, 1}


def test_await_status_equals_batch(spark, tmp_path):
    rows = [(1, 0, 0, 0, "pending"), (1, 1, 0, 10, "running"), (2, 2, 0, 0, "pending"), (2, 3, 0, 5, "terminated"), (3, 4, 0, 0, "pending")]
    log = spark.createDataFrame(rows, feeds.STATUS_EVENT)
    got = feeds.run_await_status(spark, staged(log, tmp_path, 3), "running", 50, files_per_trigger=1)
    want = ST.await_status(log, "running", 50).select("entity_id", "outcome")
    assert sorted(got.collect()) == sorted(want.collect())


def test_timeout_closes_silent_jobs(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    rows = [
        (1, 0, E.QUEUED, "{}", at), (1, 1, E.DONE, "{}", at + dt.timedelta(seconds=5)),
        (2, 0, E.QUEUED, "{}", at), (2, 1, E.UPDATE, "{}", at + dt.timedelta(seconds=9)),
        # A later job moves event time on.
        (3, 0, E.QUEUED, "{}", at + dt.timedelta(hours=2)),
    ]
    schema = "job_id BIGINT, seq BIGINT, name STRING, payload STRING, ts TIMESTAMP"
    path, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    feed = feeds.read_feed(spark, path, schema)
    closed = feeds.job_state_with_timeout(feed, "ts", "1 minute", 10 * 60 * 1000)
    feeds.to_end(closed, feeds._batch_writer(out), cp)
    got = {r["job_id"]: (r["status"], r["error"]) for r in spark.read.parquet(out).collect()}
    assert got[1] == ("successful", None)
    assert got[2][0] == "error" and got[2][1].startswith('SSE stream ended after 2 event(s), last event "parse_update"')
    assert 3 not in got


def test_stream_dataset(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"Title {i}\n" + "word " * 40) for i in range(6)], "doc_id bigint, text string")
    path = staged(docs, tmp_path, 3)
    done = []
    feed = feeds.read_feed(spark, path, "doc_id BIGINT, text STRING", files_per_trigger=1)
    q = ingest.stream_dataset(
        feed, Configuration(ParsingOptions(chunking_strategy="section")), str(tmp_path / "out"), str(tmp_path / "cp"),
        on_done=lambda s, p, b: done.append(b),
    )
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.select("doc_id").distinct().count() == out.count() == 6
    assert done == [0, 1, 2]
    assert out.where(F.size("chunks") == 1).count() == 6
    assert json.loads(out.select(F.to_json("usage")).first()[0])["pages_parsed"] == 1


def test_an_ended_job_stays_ended_in_later_batches(spark, tmp_path):
    """Rows after the end come in files of their own, so in later micro-batches; the batch reducer is the measure."""
    at = dt.datetime(2024, 1, 1)
    schema = "job_id BIGINT, seq BIGINT, name STRING, payload STRING, ts TIMESTAMP"
    files = [
        [(1, 0, E.QUEUED, "{}", at), (2, 0, E.FAILED, '{"error":"x"}', at), (4, 0, E.DONE, "{}", at)],
        [(1, 1, E.DONE, '{"a":1}', at + dt.timedelta(seconds=5)), (2, 1, E.DONE, "{}", at + dt.timedelta(seconds=5))],
        [(1, 2, E.UPDATE, "{}", at + dt.timedelta(seconds=9)), (1, 3, E.FAILED, "{}", at + dt.timedelta(seconds=9)), (4, 1, E.DONE, "{}", at)],
        [(3, 0, E.QUEUED, "{}", at + dt.timedelta(hours=2))],
        [(3, 1, E.DONE, "{}", at + dt.timedelta(hours=2, seconds=1))],
    ]
    path, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    every = []
    for rows in files:
        every += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        feed = feeds.read_feed(spark, path, schema, files_per_trigger=1)
        feeds.to_end(feeds.job_state_with_timeout(feed, "ts", "1 minute", 10 * 60 * 1000), feeds._batch_writer(out), cp)
    got = spark.read.parquet(out).select("job_id", "status", "error", "result").collect()
    want = E.job_state(spark.createDataFrame(every, schema).drop("ts")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 4


def test_marks_of_closed_feeds_stay_few(spark, tmp_path):
    """Fifty micro-batches, each closing two runs: marks leave with their feeds' silence, and closed runs stay closed before."""
    sink, keep = str(tmp_path / "out"), 4
    step = feeds._until_closed(sink, "run_id", lambda df: df.select("run_id", "seq"), lambda df: df.where("name = 'eof'"), keep=keep)
    marks = []
    for i in range(50):
        rows = [(2 * i, 0, "eof", "{}"), (2 * i + 1, 0, "eof", "{}"), (10_000, i, "eof", "{}")]
        if i >= keep:
            rows.append((2 * (i - keep + 1), 1, "output", "{}"))  # closed three micro-batches ago
        step(spark.createDataFrame(rows, feeds.OUTPUT_EVENT).coalesce(1), i)
        if i in (10, 20, 49):
            marks.append(spark.read.parquet(f"{sink}/closed/{i % 2}").count())
    assert max(marks) <= 3 * keep + 2 and marks[0] == marks[1] == marks[2]
    got = spark.read.parquet(f"{sink}/rows")
    assert got.where("seq > 0").count() == 0 and got.count() == 101
    assert sorted(p.name for p in (tmp_path / "out" / "closed").iterdir()) == ["0", "1"]
    # A repeated micro-batch finds the marks of the one before.
    step(spark.createDataFrame([(10_000, 50, "eof", "{}"), (98, 5, "output", "{}")], feeds.OUTPUT_EVENT), 49)
    assert spark.read.parquet(f"{sink}/rows/batch_id=49").where("run_id = 10000").count() == 0


SECOND, EPOCH = 1_000_000, 1_700_000_000


def waits(spark, tmp_path, files, **options):
    path = str(tmp_path / "in")
    for rows in files:
        spark.createDataFrame(rows, feeds.STATUS_EVENT).coalesce(1).write.mode("append").parquet(path)
    feed = feeds.read_feed(spark, path, feeds.STATUS_EVENT, files_per_trigger=1)
    out = str(tmp_path / "out")
    feeds.to_end(feeds.await_with_deadline(feed, "running", 50 * SECOND, **options), feeds._batch_writer(out), str(tmp_path / "cp"))
    return spark.read.schema(feeds.WAIT_OUT + ", batch_id BIGINT").parquet(out).orderBy("batch_id", "entity_id").collect()


def entry(entity, event, second, status):
    return (entity, event, 0, None if second is None else (EPOCH + second) * SECOND, status)


def test_deadlines_pass_without_further_rows(spark, tmp_path):
    files = [
        [entry(1, 0, 0, "pending"), entry(2, 1, 0, "pending"), entry(3, 2, 0, "pending"), entry(4, 3, 0, "pending")],
        [entry(1, 4, 10, "running"), entry(2, 5, 20, "terminated"), entry(9, 6, None, "running")],
        [entry(None, 7, 70, None)],  # a heartbeat: nothing else comes from entity 3
        [entry(5, 8, 80, "pending"), entry(1, 9, 81, "terminated"), entry(3, 10, 82, "running"), entry(2, 11, 83, "running")],
        [entry(None, 12, 85, "pending")],
    ]
    got = waits(spark, tmp_path, files)
    log = spark.createDataFrame([r for rows in files for r in rows if r[0] not in (None, 9)], feeds.STATUS_EVENT)
    want = {tuple(r) for r in ST.await_status(log, "running", 50 * SECOND).collect() if r["entity_id"] != 5}
    assert {tuple(r)[:3] for r in got} == want and len(got) == 4  # entity 5 still waits
    last = max(r["batch_id"] for r in got)
    assert {r["entity_id"] for r in got if r["outcome"] == "timed_out"} == {3, 4}
    assert last == 3 and {r["entity_id"] for r in got if r["batch_id"] == last} >= {3, 4}  # before the stream's end


def test_waits_bear_disorder_within_the_delay(spark, tmp_path):
    files = [
        [entry(1, 0, 30, "running"), entry(2, 1, 25, "pending")],
        [entry(1, 2, 22, "terminated"), entry(1, 3, 20, "pending"), entry(2, 4, 24, "running"), entry(2, 5, 18, "pending")],
        [entry(None, 6, 500, None)],
    ]
    got = waits(spark, tmp_path, files, delay="1 minute")
    assert [tuple(r)[:3] for r in got] == [(1, "terminated", None), (2, "ready", 6 * SECOND)]


def test_marks_of_decided_waits_leave(spark, tmp_path):
    """Within the time a mark is kept later rows change nothing; after it they begin a new wait."""
    files = [
        [entry(1, 0, 0, "running")], [entry(None, 1, 10, None)], [entry(1, 2, 15, "running")], [entry(None, 3, 16, None)],
        [entry(None, 4, 100, None)], [entry(1, 5, 120, "running")], [entry(None, 6, 200, None)],
    ]
    got = waits(spark, tmp_path, files, keep_ms=60_000)
    assert [tuple(r)[:3] for r in got] == [(1, "ready", 0)] * 2
