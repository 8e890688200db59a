import json

from pyspark.sql import functions as F

from docspark.operators import events as E

Q, U, D, X = E.QUEUED, E.UPDATE, E.DONE, E.FAILED


def events(spark, feeds):
    rows = [(j, i, n, p) for j, feed in feeds.items() for i, (n, p) in enumerate(feed)]
    return spark.createDataFrame(rows, "job_id bigint, seq bigint, name string, payload string")


FEEDS = {
    1: [(Q, "{}"), (U, "{}"), (D, '{"status":"successful"}'), (U, "not json")],
    2: [(Q, "{}"), (X, '{"error":"broken page"}'), (D, "{}")],
    3: [(Q, "{}"), ("parse_other", "{}"), (D, "{}")],
    4: [(Q, "{}"), (U, "{}")],
    5: [(D, "{")],
    6: [("parse_other", None), (D, "{}")],
    7: [(X, "{}")],
}


def test_job_state(spark):
    jobs = spark.createDataFrame([(j,) for j in [*FEEDS, 8]], "job_id bigint")
    got = {r["job_id"]: r for r in E.job_state(events(spark, FEEDS), jobs).collect()}
    assert (got[1]["status"], got[1]["error"], got[1]["result"]) == ("successful", None, '{"status":"successful"}')
    assert (got[2]["status"], got[2]["error"]) == ("failure", "failed to parse result: broken page")
    assert got[3]["error"] == "unknown SSE event: parse_other"
    assert got[4]["error"] == (
        'SSE stream ended after 2 event(s), last event "parse_update", '
        "without a terminal event (parse_done or parse_failed)"
    )
    assert got[5]["error"] == E.BAD_PAYLOAD
    assert got[6]["error"] == E.BAD_PAYLOAD
    assert got[7]["error"] == "failed to parse result: "
    assert got[8]["error"] == "SSE stream closed without sending any events"


def test_job_updates(spark):
    for limits in ({}, {"min_rows": 1}):
        rows = E.job_updates(events(spark, FEEDS), **limits).collect()
        seen = {}
        for r in sorted(rows, key=lambda r: (r["job_id"], r["seq"])):
            seen.setdefault(r["job_id"], []).append(r["name"])
        assert seen == {1: [Q, U, D], 2: [Q, X], 3: [Q], 4: [Q, U], 7: [X]}


def out(line, stream="stdout", at=1):
    return ("output", json.dumps({"line": line, "timestamp": at, "stream": stream}))


RUNS = {
    1: [out("a"), out("b", "stderr"), ("eof", ""), out("late")],
    2: [out("a"), ("heartbeat", "not json"), out("b")],
    3: [out("a"), ("output", "oops"), out("b"), ("eof", "")],
    4: [("eof", None)],
}


def follow(spark, stream=None, **limits):
    df = events(spark, RUNS).withColumnRenamed("job_id", "run_id")
    got = {}
    for r in E.follow_output(df, stream, **limits).orderBy("run_id", "seq").collect():
        got.setdefault(r["run_id"], []).append(r["error"] or r["line"])
    return got


def test_follow_output(spark):
    for limits in ({}, {"min_rows": 1}):
        assert follow(spark, **limits) == {1: ["a", "b"], 2: ["a", "b"], 3: ["a", E.BAD_OUTPUT]}
    assert follow(spark, "stderr") == {1: ["b"], 3: [E.BAD_OUTPUT]}


def test_collect_output_in_parts(spark):
    rows = [(1, i, f"l{i}", "stdout" if i % 2 else "stderr") for i in range(7)] + [(2, 0, "x", "stdout")]
    df = spark.createDataFrame(rows, "run_id bigint, seq bigint, line string, stream string")
    for limits in ({}, {"min_rows": 2}):
        parts = E.collect_output(df, part_lines=3, **limits).orderBy("run_id", "part_no").collect()
        assert [(p["run_id"], p["first_line"], p["lines"]) for p in parts] == [
            (1, 1, ["l0", "l1", "l2"]), (1, 4, ["l3", "l4", "l5"]), (1, 7, ["l6"]), (2, 1, ["x"]),
        ]
    assert [r["lines"] for r in E.collect_output(df, "stderr").collect()] == [["l0", "l2", "l4", "l6"]]


def test_merge_streams(spark):
    a = spark.createDataFrame([(1, "x")], "pid int, line string")
    got = E.merge_streams(a, a).orderBy("stream").collect()
    assert [r["stream"] for r in got] == ["stderr", "stdout"]


def test_valid_json(spark):
    df = spark.createDataFrame([("{}",), ("1",), ("{",), ("",), (None,), ("[1]",), ('{"a":1} x',), ('{"a":1},{"b":2}',), ('{"a":1,"a":2}',), (" null ",),
                                ("{'a':1}",), ('{"a":{"b":[1]}}',), ('"x"',)], "p string")
    assert [r[0] for r in df.select(E.valid_json("p")).collect()] == [
        True, False, False, False, False, False, False, False, True, True, False, True, False]
    assert df.where(F.col("p").isNull()).count() == 1
