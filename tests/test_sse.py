"""Event framing against a line-by-line reading of the rules."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docspark.operators import events as E

BLANKS = " \t\r\n\x0b\x0c"


def read(lines):
    """One stream, read line by line."""
    out, event, run, no = [], {}, None, 0

    def close():
        nonlocal run
        if run is not None:
            event["data"] = "\n".join(run)
            run = None

    def emit():
        if any(event.get(k) for k in ("event", "id", "retry", "data")):
            out.append((no, *[event.get(k, "") for k in ("event", "id", "retry", "data")], None))

    for line in lines:
        if len(line.encode()) >= E.MAX_LINE_BYTES:
            return [*out, (no, "", "", "", "", E.TOO_LONG)]
        line = line.removesuffix("\r")
        if line == "":
            close()
            emit()
            event, no = {}, no + 1
            continue
        if ":" not in line:
            return [*out, (no, "", "", "", "", f'{E.MALFORMED}"{line}"')]
        field, value = line.split(":", 1)
        value = value.strip(BLANKS)
        if field == "data":
            run = [*(run or []), value]
        else:
            close()
            if field in ("event", "id", "retry"):
                event[field] = value
    close()
    emit()
    return out


def framed(spark, streams, **limits):
    rows = [(i, n, line) for i, lines in enumerate(streams) for n, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "stream_id bigint, line_no bigint, line string")
    got = {i: [] for i in range(len(streams))}
    for r in E.parse_sse(df, **limits).orderBy("stream_id", "event_no").collect():
        got[r["stream_id"]].append(tuple(r[c] for c in ("event_no", "name", "id", "retry", "data", "error")))
    return [got[i] for i in range(len(streams))]


CASES = [
    ["event: a", "data: 1", "", "event: b", "data: 2", ""],
    ["data: 1", "data: 2", ""],
    ["data: 1", "id: 5", "data: 2", ""],
    [": note", "data: 1", "other: x", ""],
    ["data: 1", ": note", "data: 2", ""],
    ["event: a", "data: last without a blank"],
    ["data: 1\r", "\r", "event: b\r", "\r"],
    ["data: kept", "", "event: lost", "no colon", "data: after", ""],
    ["no colon"],
    ["", "", ""],
    ["data:", ""],
    ["data:", "data:", ""],
    ["retry: 10", "", "id:7", ""],
    ["data: " + "x" * E.MAX_LINE_BYTES, ""],
    ["data: ok", "", "data: " + "x" * (E.MAX_LINE_BYTES - 7), "", "y" * E.MAX_LINE_BYTES],
    ["data: a: b:c", "event:  spaced \t", ""],
]


def test_cases(spark):
    want = [read(c) for c in CASES]
    assert framed(spark, CASES) == want
    assert framed(spark, CASES, min_rows=2) == want


LINE = st.sampled_from(
    ["", "\r", "data: 1", "data:2", "data: ", "event: a", "event:b ", "id: 3", "retry: 4", ": c", "x: y", "bad", "data: a:b"]
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(LINE, max_size=14), min_size=8, max_size=30))
def test_random_streams(spark, streams):
    assert framed(spark, streams, min_rows=3) == [read(s) for s in streams]
