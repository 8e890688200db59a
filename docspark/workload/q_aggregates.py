"""Aggregations (AGG) and status windows (WIN-6/7) over the driver tables."""

from pyspark.sql import functions as F

from docspark.operators import analytics, classify, fragments, latency, pages, status
from docspark.schemas import USAGE_COUNTERS
from docspark.workload import doc_sql as D
from docspark.workload import tables as t
from docspark.workload.registry import query


@query("agg_1_dataset_analytics", f"""WITH {t.JOBS}
SELECT dataset_id, count(*) FILTER (WHERE status NOT IN ('pending', 'failure', 'successful')) AS total_processing_parse_jobs,
  count(*) FILTER (WHERE status = 'pending') AS total_pending_parse_jobs,
  count(*) FILTER (WHERE status = 'failure') AS total_error_parse_jobs,
  count(*) FILTER (WHERE status = 'successful') AS total_successful_parse_jobs, count(*) AS total_jobs
FROM jobs GROUP BY dataset_id""")
def dataset_analytics(spark, sf_dir):
    return analytics.dataset_analytics(t.jobs(spark, sf_dir))


_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in USAGE_COUNTERS)


@query("agg_2_usage_summary", f"""WITH {t.JOBS}, {t.USAGE}
SELECT dataset_id, job_type, CAST(grouping(dataset_id, job_type) AS INTEGER) AS level, count(DISTINCT parse_id) AS jobs, {_SUMS}
FROM usage_rows JOIN (SELECT parse_id, dataset_id, job_type FROM jobs WHERE status = 'successful') USING (parse_id)
GROUP BY ROLLUP (dataset_id, job_type)""")
def usage_summary(spark, sf_dir):
    return analytics.usage_summary(t.usage(spark, sf_dir), t.jobs(spark, sf_dir))


@query("agg_3_page_classes", f"""WITH {t.TABLE_ROWS},
lab AS (SELECT DISTINCT doc_id, page_number, cells[3] AS page_class, 'row ' || cells[3] AS reason FROM table_rows)
SELECT doc_id, page_class, string_agg(CAST(page_number AS VARCHAR), ',' ORDER BY page_number) AS page_numbers,
       string_agg(page_number || '=' || reason, ',' ORDER BY page_number) AS reasons
FROM lab GROUP BY doc_id, page_class""")
def page_classes(spark, sf_dir):
    cls = F.element_at("cells", 3)
    lab = t.table_rows(spark, sf_dir).select(
        "doc_id", "page_number", cls.alias("page_class"), F.concat(F.lit("row "), cls).alias("reason")
    ).distinct()
    entries = F.transform(
        F.array_sort(F.map_entries("classification_reasons")), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"])
    )
    return classify.collect_page_classes(lab).select(
        "doc_id", "page_class",
        F.array_join(F.col("page_numbers").cast("array<string>"), ",").alias("page_numbers"),
        F.array_join(entries, ",").alias("reasons"),
    )


@query("agg_4_metering", f"""WITH {D.CORE}
SELECT doc_id, count(DISTINCT page_number) AS pages_parsed,
  count(DISTINCT CASE WHEN fragment_type = 'signature' THEN page_number END) AS signature_detected_pages,
  count(DISTINCT CASE WHEN fragment_type = 'strikethrough' THEN page_number END) AS strikethrough_detected_pages
FROM fr GROUP BY doc_id""")
def metering(spark, sf_dir):
    return analytics.meter(fragments.fragment_text(pages.split_pages(t.load(spark, sf_dir, "documents"))))


@query("agg_5_progress", """
SELECT o_orderkey AS parse_id, tasks_completed_count, tasks_total_count, tasks_completed_count / tasks_total_count AS share_done,
       parsed_pages_count, total_pages
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'F') AS tasks_completed_count, count(*) AS tasks_total_count,
       count(*) FILTER (WHERE l_returnflag <> 'N') AS parsed_pages_count, count(*) AS total_pages
       FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""")
def progress(spark, sf_dir):
    tasks = t.load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("parse_id"), (F.col("l_linestatus") == "F").alias("done")
    )
    pages = t.load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("parse_id"), (F.col("l_returnflag") != "N").alias("parsed")
    )
    return analytics.progress(t.jobs(spark, sf_dir), tasks, pages)


# Nearest rank: index ceil(p*n)-1 of the sorted values, clamped.
def _stats_sql(by: str) -> str:
    pct = ", ".join(
        f"max(CASE WHEN rn = greatest(least(CAST(ceil({p}::DOUBLE * n) AS BIGINT), n), 1) THEN ns END) AS \"{name}\""
        for name, p in latency.LEVELS.items()
    )
    return f"""st AS (
  SELECT {by}, max(n) AS n, max(m) AS "Mean", CAST(floor(sqrt(CAST(sum(CAST(ns - m AS HUGEINT) * (ns - m)) AS DOUBLE) / max(n))) AS BIGINT) AS "Stddev", {pct}
  FROM (SELECT *, CAST(sum(ns) OVER (PARTITION BY {by}) // n AS BIGINT) AS m
        FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY ns) AS rn, count(*) OVER (PARTITION BY {by}) AS n
              FROM runs WHERE error IS NULL))
  GROUP BY {by})"""


@query("agg_6_latency_percentiles", f"""WITH {t.LATENCY}, {_stats_sql("level")} SELECT * FROM st""")
def percentiles(spark, sf_dir):
    ok, _ = latency.split_outcome(t.latency_runs(spark, sf_dir))
    return latency.latency_summary(ok, ["level"], "ns")


@query("agg_7_mean_stddev", f"""WITH {t.LATENCY}, {_stats_sql("level, repeat_no")}
SELECT level, repeat_no, n, "Mean", "Stddev" FROM st""")
def mean_stddev(spark, sf_dir):
    ok, _ = latency.split_outcome(t.latency_runs(spark, sf_dir))
    return latency.moments(ok, ["level", "repeat_no"], "ns")


@query("agg_8_repeat_summary", f"""WITH {t.LATENCY}, {_stats_sql("level, repeat_no")},
long AS (SELECT level, unnest([{", ".join(f"'{r}'" for r in latency.ROWS)}]) AS row,
                unnest([{", ".join(f'"{r}"' for r in latency.ROWS)}]) AS x FROM st)
SELECT level, row, round(avg(x), 3) AS mean, round(stddev_pop(x), 3) AS stddev, count(*) AS repeats FROM long GROUP BY level, row""")
def repeat_summary(spark, sf_dir):
    ok, _ = latency.split_outcome(t.latency_runs(spark, sf_dir))
    return latency.repeat_summary(ok, "level", "repeat_no", "ns").select(
        "level", "row", F.round("mean", 3).alias("mean"), F.round("stddev", 3).alias("stddev"), "repeats"
    )


_ZERO = ", ".join(f'coalesce(st."{r}", 0) AS "{r}"' for r in latency.ROWS)


@query("agg_9_run_report", f"""WITH {t.LATENCY}, {_stats_sql("level, repeat_no")},
c AS (SELECT level, repeat_no, count(*) FILTER (WHERE error IS NULL) AS succeeded, count(*) FILTER (WHERE error IS NOT NULL) AS failed,
             max(started_ns + ns) - min(started_ns) AS wall_ns FROM runs GROUP BY level, repeat_no)
SELECT c.level, c.repeat_no, succeeded, failed, wall_ns, {_ZERO}
FROM c LEFT JOIN st ON st.level = c.level AND st.repeat_no = c.repeat_no""")
def run_report(spark, sf_dir):
    return latency.run_report(
        t.latency_runs(spark, sf_dir), ["level", "repeat_no"], "ns", "error", "started_ns", "ended_ns"
    )


@query("win_6_time_to_state", f"""WITH {t.STATUS_LOG},
f AS (SELECT entity_id, min(ts_us) AS r, min(ts_us) FILTER (WHERE status = 'pending') AS p,
             min(ts_us) FILTER (WHERE status = 'running') AS g, min(ts_us) FILTER (WHERE status = 'terminated') AS e
      FROM status_log GROUP BY entity_id),
-- A run counts only if it is reached before the entity ends.
ok AS (SELECT *, CASE WHEN p < g THEN p ELSE g END AS made FROM f WHERE g IS NOT NULL AND (e IS NULL OR g <= e))
SELECT f.entity_id, made - ok.r AS create_wait, ok.g - made AS pending_wait, ok.g - ok.r AS ready_wait,
       CASE WHEN ok.entity_id IS NOT NULL THEN NULL WHEN f.e IS NOT NULL THEN 'sandbox terminated unexpectedly'
            ELSE 'timed out waiting for running' END AS error
FROM f LEFT JOIN ok ON ok.entity_id = f.entity_id""")
def time_to_state(spark, sf_dir):
    return status.time_to_state(t.status_log(spark, sf_dir))


_PAIRS = ", ".join(f"('{a}', '{b}')" for a, b in status.LIFE_CYCLE)


@query("win_7_audit_transitions", f"""WITH {t.STATUS_LOG},
s AS (SELECT *, lag(status) OVER (PARTITION BY entity_id ORDER BY ts_us, event_id) AS prev_status FROM status_log)
SELECT entity_id, event_id, prev_status, status FROM s WHERE prev_status <> status
AND (prev_status, status) NOT IN (VALUES {_PAIRS})""")
def audit(spark, sf_dir):
    out = status.audit_transitions(t.status_log(spark, sf_dir), ties=["event_id"])
    return out.select("entity_id", "event_id", "prev_status", "status")


@query("str_4_await_status", f"""WITH {t.STATUS_LOG},
f AS (SELECT entity_id, min(ts_us) AS s, min(ts_us) FILTER (WHERE status = 'running') AS g,
             min(ts_us) FILTER (WHERE status = 'terminated') AS e FROM status_log GROUP BY entity_id),
d AS (SELECT entity_id, s, CASE WHEN g < s + 43200000000 THEN g END AS g, CASE WHEN e < s + 43200000000 THEN e END AS e FROM f)
SELECT entity_id, CASE WHEN g IS NOT NULL AND (e IS NULL OR g < e) THEN 'ready' WHEN e IS NOT NULL THEN 'terminated' ELSE 'timed_out' END AS outcome,
       CASE WHEN g IS NOT NULL AND (e IS NULL OR g < e) THEN g - s END AS waited FROM d""")
def await_status(spark, sf_dir):
    """Wait for ``running`` for at most twelve hours."""
    return status.await_status(t.status_log(spark, sf_dir), "running", 12 * 3600 * 1_000_000)
