"""Event feeds (STR, AGG-10, SET-1, WIN-5) over the driver tables."""

from pyspark.sql import functions as F

from docspark.operators import events as E
from docspark.schemas import PARSE_EVENT
from docspark.session import shared_dir
from docspark.streaming import feeds
from docspark.workload import tables as t
from docspark.workload.registry import query

JUDGED = f"""{t.JOB_EVENTS},
jd AS (SELECT *, CASE WHEN coalesce(CASE WHEN json_valid(payload) THEN json_type(payload) END, '') NOT IN ('OBJECT', 'NULL') THEN 'bad' WHEN name IN ('parse_queued', 'parse_update') THEN 'go'
         WHEN name = 'parse_done' THEN 'done' WHEN name = 'parse_failed' THEN 'failed' ELSE 'unknown' END AS kind FROM job_events)"""

STATE = f"""{JUDGED},
red AS (SELECT job_id, min(seq) FILTER (WHERE kind <> 'go') AS stop, count(*) AS n, max(seq) AS last_seq FROM jd GROUP BY job_id),
state AS (SELECT r.job_id, coalesce(CASE s.kind WHEN 'done' THEN 'successful' WHEN 'failed' THEN 'failure' END, 'error') AS status,
   CASE WHEN s.kind = 'failed' THEN 'failed to parse result: ' || coalesce(json_extract_string(s.payload, '$.error'), '')
        WHEN s.kind = 'bad' THEN 'failed to unmarshal SSE event' WHEN s.kind = 'unknown' THEN 'unknown SSE event: ' || s.name
        WHEN s.kind IS NULL THEN 'SSE stream ended after ' || r.n || ' event(s), last event "' || l.name || '", without a terminal event (parse_done or parse_failed)'
   END AS error, CASE WHEN s.kind = 'done' THEN s.payload END AS result
 FROM red r LEFT JOIN jd s ON s.job_id = r.job_id AND s.seq = r.stop LEFT JOIN jd l ON l.job_id = r.job_id AND l.seq = r.last_seq)"""

# Each (user, day) is one job here, so that many jobs end in every way.
DAILY = "user_id * 1000 + CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT)"


def daily_events(spark, sf_dir):
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("bigint")
    return t.job_events(spark, sf_dir, F.col("user_id") * 1000 + day)


@query("str_1_job_state", f"WITH {STATE.replace('user_id AS job_id', f'{DAILY} AS job_id')} SELECT * FROM state")
def job_state(spark, sf_dir):
    return E.job_state(daily_events(spark, sf_dir))


@query("str_1_job_state_silent_jobs", f"""WITH {STATE}
SELECT c_custkey AS job_id, coalesce(status, 'error') AS status, CASE WHEN state.job_id IS NULL THEN 'SSE stream closed without sending any events' ELSE error END AS error
FROM customer LEFT JOIN state ON job_id = c_custkey""")
def silent_jobs(spark, sf_dir):
    """Every customer is a job; those without events closed in silence."""
    jobs = t.load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("job_id"))
    return E.job_state(t.job_events(spark, sf_dir), jobs).drop("result")


@query("win_5_latest_state", f"""WITH {JUDGED}
SELECT job_id, count(*) AS events, arg_max(name, seq) FILTER (WHERE kind = 'go') AS last_progress FROM jd GROUP BY job_id""")
def latest_state(spark, sf_dir):
    return E.job_progress(t.job_events(spark, sf_dir))


@query("str_2_updates", f"""WITH {JUDGED.replace('user_id AS job_id', f'{DAILY} AS job_id')},
s AS (SELECT job_id, min(seq) AS stop FROM jd WHERE kind <> 'go' GROUP BY job_id)
SELECT jd.job_id, jd.seq, jd.name, jd.kind FROM jd LEFT JOIN s ON s.job_id = jd.job_id
WHERE (stop IS NULL OR seq <= stop) AND kind IN ('go', 'done', 'failed')""")
def updates(spark, sf_dir):
    """Rows an update callback receives."""
    return E.job_updates(daily_events(spark, sf_dir)).select("job_id", "seq", "name", "kind")


FOLLOW = f"""{t.RUN_OUTPUT},
stop AS (SELECT run_id, min(seq) AS stop FROM run_output WHERE name = 'eof' OR (name = 'output' AND bad) GROUP BY run_id),
fo AS (SELECT o.run_id, o.seq, CASE WHEN bad THEN NULL ELSE line END AS line, CASE WHEN bad THEN NULL ELSE seq END AS "timestamp",
         CASE WHEN bad THEN NULL ELSE stream END AS stream, CASE WHEN bad THEN 'failed to decode output event' END AS error
       FROM run_output o LEFT JOIN stop s ON s.run_id = o.run_id WHERE name = 'output' AND (stop IS NULL OR seq < stop OR (seq = stop AND bad)))"""


@query("str_3_follow_output", f"WITH {FOLLOW} SELECT * FROM fo")
def follow_output(spark, sf_dir):
    return E.follow_output(t.run_output(spark, sf_dir))


@query("str_3_follow_stdout", f"""WITH {FOLLOW}
SELECT run_id, seq, line, "timestamp", error FROM fo WHERE stream = 'stdout' OR error IS NOT NULL""")
def follow_stdout(spark, sf_dir):
    return E.follow_output(t.run_output(spark, sf_dir), "stdout")


def _captured_sql(where: str) -> str:
    return f"""WITH c AS (SELECT conv_id AS run_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, text AS line
  FROM conversations WHERE {where})
SELECT run_id, (n - 1) // 3 AS part_no, min(n) AS first_line, string_agg(line, chr(10) ORDER BY n) AS lines, count(*) AS part_line_count
FROM c GROUP BY run_id, (n - 1) // 3"""


def _captured(spark, sf_dir, stream):
    out = E.collect_output(t.captured_output(spark, sf_dir), stream, part_lines=3)
    return out.withColumn("lines", F.array_join("lines", "\n"))


@query("agg_10_captured_merged", _captured_sql("TRUE"))
def captured_merged(spark, sf_dir):
    return _captured(spark, sf_dir, None)


@query("agg_10_captured_stdout", _captured_sql("role = 'assistant'"))
def captured_stdout(spark, sf_dir):
    return _captured(spark, sf_dir, "stdout")


@query("agg_10_captured_stderr", _captured_sql("role <> 'assistant'"))
def captured_stderr(spark, sf_dir):
    return _captured(spark, sf_dir, "stderr")


@query("agg_10_line_counts", """
SELECT conv_id AS run_id, CASE WHEN role = 'assistant' THEN 'stdout' ELSE 'stderr' END AS stream, count(*) AS line_count
FROM conversations GROUP BY ALL""")
def line_counts(spark, sf_dir):
    return E.output_counts(t.captured_output(spark, sf_dir), by_stream=True)


@query("set_1_merge_streams", """
SELECT conv_id AS run_id, turn AS seq, text AS line, CASE WHEN role = 'assistant' THEN 'stdout' ELSE 'stderr' END AS stream FROM conversations""")
def merge_streams(spark, sf_dir):
    c = t.captured_output(spark, sf_dir)
    out = c.where("stream = 'stdout'").drop("stream")
    err = c.where("stream = 'stderr'").drop("stream")
    return E.merge_streams(out, err)


# ---- streams: the same outcomes from a file stream run to its end --------


@query("str_1_job_state_stream", f"WITH {STATE} SELECT job_id, status, error FROM state")
def job_state_stream(spark, sf_dir):
    path = feeds.stage(t.job_events(spark, sf_dir), "job_events")
    return feeds.run_job_state(spark, path).select("job_id", "status", "error")


@query("udf_1_update_callback", f"""WITH {JUDGED},
s AS (SELECT job_id, min(seq) AS stop FROM jd WHERE kind <> 'go' GROUP BY job_id)
SELECT jd.job_id, jd.seq, jd.name FROM jd LEFT JOIN s ON s.job_id = jd.job_id
WHERE (stop IS NULL OR seq <= stop) AND kind IN ('go', 'done', 'failed')""")
def update_callback(spark, sf_dir):
    """A user's callback sees every update row of the stream; this one stores them."""
    work = shared_dir(spark)

    def on_update(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{work}/seen/batch_id={batch_id}")

    feed = feeds.read_feed(spark, feeds.stage(t.job_events(spark, sf_dir), "updates"), PARSE_EVENT)
    feeds.updates_to(feed, f"{work}/out", f"{work}/checkpoint", on_update).awaitTermination()
    return spark.read.parquet(f"{work}/seen").select("job_id", "seq", "name")


@query("str_3_follow_stream", f"WITH {FOLLOW} SELECT run_id, seq, line, stream, error FROM fo")
def follow_stream(spark, sf_dir):
    path = feeds.stage(t.run_output(spark, sf_dir), "run_output")
    return feeds.run_follow_output(spark, path).select("run_id", "seq", "line", "stream", "error")


@query("set_2_replay_then_live", """SELECT conv_id AS run_id, turn AS seq FROM conversations""")
def replay(spark, sf_dir):
    """Captured rows are replayed from the earliest file, then later ones follow."""
    out = t.run_output(spark, sf_dir)
    path = feeds.stage(out.where("seq < 2"), "replay")
    return feeds.replay_then_live(spark, path, out.where("seq >= 2")).select("run_id", "seq")


@query("str_4_await_status_stream", f"""WITH {t.STATUS_LOG},
f AS (SELECT entity_id, min(ts_us) AS s, min(ts_us) FILTER (WHERE status = 'running') AS g,
             min(ts_us) FILTER (WHERE status = 'terminated') AS e FROM status_log GROUP BY entity_id),
d AS (SELECT entity_id, s, CASE WHEN g < s + 43200000000 THEN g END AS g, CASE WHEN e < s + 43200000000 THEN e END AS e FROM f)
SELECT entity_id, CASE WHEN g IS NOT NULL AND (e IS NULL OR g < e) THEN 'ready' WHEN e IS NOT NULL THEN 'terminated' ELSE 'timed_out' END AS outcome FROM d""")
def await_stream(spark, sf_dir):
    path = feeds.stage(t.status_log(spark, sf_dir), "status_log")
    return feeds.run_await_status(spark, path, "running", 12 * 3600 * 1_000_000).select("entity_id", "outcome")


@query("str_4_await_deadline_stream", f"""WITH {t.STATUS_LOG},
f AS (SELECT entity_id, min(ts_us) AS s, min(ts_us) FILTER (WHERE status = 'running') AS g,
             min(ts_us) FILTER (WHERE status = 'terminated') AS e FROM status_log GROUP BY entity_id),
d AS (SELECT entity_id, s, CASE WHEN g < s + 43200000000 THEN g END AS g, CASE WHEN e < s + 43200000000 THEN e END AS e FROM f),
o AS (SELECT entity_id, s, CASE WHEN g IS NOT NULL AND (e IS NULL OR g < e) THEN 'ready' WHEN e IS NOT NULL THEN 'terminated' ELSE 'timed_out' END AS outcome, g, e
      FROM d)
SELECT entity_id, outcome, CASE WHEN outcome = 'ready' THEN g - s END AS waited FROM o
WHERE CASE outcome WHEN 'ready' THEN g WHEN 'terminated' THEN e ELSE s + 43200000000 END // 1000 < (SELECT max(ts_us) // 1000 FROM status_log)""")
def await_deadline(spark, sf_dir):
    """Waits that event time has decided by the end of the log, each as it is decided; the others are still open."""
    path = feeds.stage(t.status_log(spark, sf_dir), "status_log")
    return feeds.run_await_deadline(spark, path, "running", 12 * 3600 * 1_000_000)
