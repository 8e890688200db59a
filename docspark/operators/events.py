"""Event feeds: line framing, the job-state reducer, output following.

Rows are ordered by an integer sequence within their feed.  Outcomes are plain
aggregates (so a feed collapses before the shuffle); where rows themselves are
kept, running totals come from :mod:`hotkeys`, which splits hot feeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions import scalars as S
from docspark.operators import hotkeys

# Event names, the line limit and the texts of errors.
QUEUED, UPDATE, DONE, FAILED = "parse_queued", "parse_update", "parse_done", "parse_failed"
OUTPUT, EOF = "output", "eof"
MAX_LINE_BYTES = 1 << 20
TOO_LONG = "event exceeded max line length of 1048576"
MALFORMED = "malformed line in SSE stream: "
BAD_PAYLOAD = "failed to unmarshal SSE event"
BAD_OUTPUT = "failed to decode output event"
BAD_SCAN = "failed to scan SSE events: "
UNKNOWN = "unknown SSE event: "
FAILED_TEXT = "failed to parse result: "
NO_EVENTS = "SSE stream closed without sending any events"
NO_TERMINAL = "without a terminal event (parse_done or parse_failed)"


# Blanks that end lines and surround values, beyond the ASCII ones.
WIDE_BLANKS = S.BLANKS + "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def valid_json(col) -> Column:
    """Whether a payload decodes into a record: one object, or ``null``, and nothing behind it.

    Repeated members are allowed.  The text is read as the only element of a
    list, so that trailing text is not overlooked.
    """
    text = S._c(col)
    one = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<struct<_any:string>>", STRICT_JSON)
    record = (F.size(one) == 1) & (F.get(one, F.lit(0)).isNotNull() | (S.trimmed(text) == "null"))
    return F.coalesce(record, F.lit(False))


def quoted(text: Column) -> Column:
    """Text in double quotes with quotes, backslashes and control characters escaped."""
    short = {7: "a", 8: "b", 9: "t", 10: "n", 11: "v", 12: "f", 13: "r"}
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for code in (*range(32), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit("\\" + short.get(code, f"x{code:02x}")))
    return F.concat(F.lit('"'), out, F.lit('"'))


# ---- framing -------------------------------------------------------------

def parse_sse(lines: DataFrame, **limits: int) -> DataFrame:
    """Lines ``(stream_id, line_no, line)`` to events.

    A blank line ends an event.  Consecutive ``data`` lines form a run and are
    joined by line breaks; any other line ends the run, and the last run of an
    event is its data.  Comments and unknown fields are ignored.  A line
    without a colon, or one of 1 MiB or more, ends the stream: the open event
    is lost and an error row takes its place.
    """
    line = F.regexp_replace("line", "\r$", "")
    blank = F.col("_line") == ""
    too_long = F.octet_length("line") >= MAX_LINE_BYTES
    bad = too_long | (~blank & ~F.col("_line").contains(":"))
    field = F.when(~blank & ~bad, F.substring_index("_line", ":", 1))
    value = F.btrim(F.expr("substring(_line, instr(_line, ':') + 1)"), F.lit(WIDE_BLANKS))
    shaped = (
        lines.withColumn("_line", line)
        .withColumn("_blank", blank)
        .withColumn("_bad", bad)
        .withColumn("_field", field)
        .withColumn("_value", value)
        .withColumn("_error", F.when(too_long, F.lit(TOO_LONG)).when(
            bad, F.concat(F.lit(MALFORMED), quoted(F.col("_line")))))
        .select("stream_id", "line_no", "_blank", "_bad", "_field", "_value", "_error")
    )
    numbered = hotkeys.running_totals(
        shaped,
        ["stream_id"],
        "line_no",
        {
            "_closed": F.col("_blank").cast("int"),
            "_breaks": (~F.coalesce(F.col("_field") == "data", F.lit(False))).cast("int"),
            "_bads": F.col("_bad").cast("int"),
        },
        **limits,
    )

    def last(name: str) -> Column:
        return F.max_by(F.when(F.col("_field") == name, F.col("_value")),
                        F.when(F.col("_field") == name, F.col("line_no")))

    data_lines = F.collect_list(
        F.when(F.col("_field") == "data", F.struct("line_no", F.col("_breaks").alias("run"), F.col("_value").alias("v")))
    )
    events = (
        numbered.where((F.col("_bads") == 0) | (F.col("_bad") & (F.col("_bads") == 1)))
        # The blank line belongs to the event it closes.
        .withColumn("event_no", F.col("_closed") - F.col("_blank").cast("int"))
        .groupBy("stream_id", "event_no")
        .agg(
            last("event").alias("name"),
            last("id").alias("id"),
            last("retry").alias("retry"),
            F.array_sort(data_lines).alias("_data"),
            F.max("_error").alias("error"),
        )
    )
    run = F.get("_data", F.size("_data") - 1)["run"]
    data = F.array_join(
        F.transform(F.filter("_data", lambda d: d["run"] == run), lambda d: d["v"]), "\n"
    )
    broken = F.col("error").isNotNull()

    def text(c: Column) -> Column:
        return F.when(~broken, F.coalesce(c, F.lit(""))).otherwise("")

    return events.select(
        "stream_id",
        "event_no",
        text(F.col("name")).alias("name"),
        text(F.col("id")).alias("id"),
        text(F.col("retry")).alias("retry"),
        text(data).alias("data"),
        "error",
    ).where(broken | (F.concat("name", "id", "retry", "data") != ""))


# ---- job state -----------------------------------------------------------

def judged(events: DataFrame) -> DataFrame:
    """Add ``kind``: what the reader does with each event.  The payload is
    decoded first, so a bad one is an error whatever the event's name.  A row
    with a framing ``error`` (see :func:`parse_sse`) ends the feed."""
    name = F.col("name")
    if "error" not in events.columns:
        events = events.withColumn("error", F.lit(None).cast("string"))
    kind = (
        F.when(F.col("error").isNotNull(), "scan")
        .when(~valid_json("payload"), "bad")
        .when(name.isin(QUEUED, UPDATE), "go")
        .when(name == DONE, "done")
        .when(name == FAILED, "failed")
        .otherwise("unknown")
    )
    return events.withColumn("kind", kind)


def job_state_aggregates() -> list[Column]:
    """Partial-able aggregates behind :func:`job_state`; also used on streams."""
    stop = F.col("kind") != "go"
    row = F.struct("seq", "kind", "name", "payload", "error")
    return [
        F.min(F.when(stop, row)).alias("_stop"),
        F.count(F.lit(1)).alias("_events"),
        F.max(F.struct("seq", "name")).alias("_last"),
    ]


def job_outcome(ended: bool = True) -> list[Column]:
    """Outcome columns from the aggregates.  ``ended``: no more rows can come."""
    kind, stop = F.col("_stop.kind"), F.col("_stop")
    detail = F.get_json_object("_stop.payload", "$.error")
    no_end = F.concat(
        F.lit("SSE stream ended after "), F.col("_events").cast("string"), F.lit(" event(s), last event "),
        quoted(F.col("_last.name")), F.lit(", " + NO_TERMINAL),
    )
    open_status = F.lit("error") if ended else F.lit("processing")
    status = (
        F.when(kind == "done", "successful")
        .when(kind == "failed", "failure")
        .when(stop.isNotNull(), "error")
        .otherwise(open_status)
    )
    error = (
        F.when(kind == "failed", F.concat(F.lit(FAILED_TEXT), F.coalesce(detail, F.lit(""))))
        .when(kind == "scan", F.concat(F.lit(BAD_SCAN), F.col("_stop.error")))
        .when(kind == "bad", F.lit(BAD_PAYLOAD))
        .when(kind == "unknown", F.concat(F.lit(UNKNOWN), F.col("_stop.name")))
        .when(kind.isNull() & F.lit(ended), F.when(F.coalesce(F.col("_events"), F.lit(0)) == 0, F.lit(NO_EVENTS)).otherwise(no_end))
    )
    return [
        status.alias("status"),
        error.alias("error"),
        F.when(kind == "done", F.col("_stop.payload")).alias("result"),
    ]


def job_state(events: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """Final state of each job from its events ``(job_id, seq, name, payload)``.

    Queued and update rows are progress; the first other row decides, and rows
    after it are ignored.  With ``jobs``, a job without any event is an error.
    """
    reduced = judged(events).groupBy("job_id").agg(*job_state_aggregates())
    if jobs is not None:
        reduced = jobs.select("job_id").join(reduced, "job_id", "left")
    return reduced.select("job_id", *job_outcome())


def feed_state(lines: DataFrame, **limits: int) -> DataFrame:
    """Final state of each feed ``(stream_id, line_no, line)``: one row per feed, framing errors included."""
    events = parse_sse(lines, **limits).select(
        F.col("stream_id").alias("job_id"), F.col("event_no").alias("seq"), "name", F.col("data").alias("payload"), "error"
    )
    feeds = lines.select(F.col("stream_id").alias("job_id")).distinct()
    return job_state(events, feeds).withColumnRenamed("job_id", "stream_id")


def job_updates(events: DataFrame, **limits: int) -> DataFrame:
    """Rows an update callback sees: up to and including the terminal event."""
    j = judged(events).drop("error")
    n = hotkeys.running_totals(j, ["job_id"], "seq", {"_stops": F.col("kind") != "go"}, **limits)
    own = (F.col("kind") != "go").cast("int")
    return n.where((F.col("_stops") == own) & (F.col("_stops") <= 1) & F.col("kind").isin("go", "done", "failed")).drop(
        "_stops"
    )


def job_progress(events: DataFrame) -> DataFrame:
    """Latest progress of each job: its last event before the end, and the count."""
    return judged(events).groupBy("job_id").agg(
        F.max(F.when(F.col("kind") == "go", F.struct("seq", "name"))).alias("_go"),
        F.count(F.lit(1)).alias("events"),
    ).select("job_id", "events", F.col("_go.name").alias("last_progress"))


# ---- output --------------------------------------------------------------

def follow_output(events: DataFrame, stream: str | None = None, **limits: int) -> DataFrame:
    """Output rows of each run up to its ``eof``.

    Only ``output`` rows are decoded; other names are skipped in silence.  A bad
    payload is an error row and ends the run.  The stream tag is part of the
    merged form only.
    """
    name = F.col("name")
    bad = (name == OUTPUT) & ~valid_json("payload")
    stop = (name == EOF) | bad
    shaped = events.where(name.isin(OUTPUT, EOF)).withColumn("_stop", F.coalesce(stop, F.lit(False)))
    n = hotkeys.running_totals(shaped, ["run_id"], "seq", {"_stops": F.col("_stop")}, **limits)
    rows = n.where((name == OUTPUT) & (F.col("_stops") == F.col("_stop").cast("int")))
    body = F.from_json("payload", "line string, timestamp bigint, stream string")
    out = rows.withColumn("_b", F.when(~F.col("_stop"), body)).select(
        "run_id",
        "seq",
        F.col("_b.line").alias("line"),
        F.col("_b.timestamp").alias("timestamp"),
        F.col("_b.stream").alias("stream"),
        F.when(F.col("_stop"), F.lit(BAD_OUTPUT)).alias("error"),
    )
    if stream is None:
        return out
    return out.where((F.col("stream") == stream) | F.col("error").isNotNull()).drop("stream")


def merge_streams(out: DataFrame, err: DataFrame) -> DataFrame:
    """Both captured outputs as one bag with a source tag."""
    return out.withColumn("stream", F.lit("stdout")).unionByName(err.withColumn("stream", F.lit("stderr")))


def collect_output(
    output: DataFrame, stream: str | None = None, part_lines: int = 1000, **limits: int
) -> DataFrame:
    """Captured lines of each run in order, as lists of at most ``part_lines``.

    A run of any length stays spread over many rows; parts are numbered from 0
    and ``first_line`` is 1-based.
    """
    rows = output if stream is None else output.where(F.col("stream") == stream)
    n = hotkeys.numbered(rows.select("run_id", "seq", "line"), ["run_id"], "seq", "line_no", **limits)
    parts = n.groupBy("run_id", F.expr(f"(line_no - 1) div {part_lines}").alias("part_no")).agg(
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_l")
    )
    return parts.select(
        "run_id",
        "part_no",
        F.get("_l", F.lit(0))["line_no"].alias("first_line"),
        F.transform("_l", lambda x: x["line"]).alias("lines"),
        F.size("_l").cast("bigint").alias("part_line_count"),
    )


def output_counts(output: DataFrame, by_stream: bool = False) -> DataFrame:
    """Line count per run (and stream)."""
    keys = ["run_id", "stream"] if by_stream else ["run_id"]
    return output.groupBy(*keys).agg(F.count(F.lit(1)).alias("line_count"))
