import pytest
from pyspark.sql import functions as F

from docspark.operators import analytics as A
from docspark.operators import status as ST
from docspark.operators import tables as T


@pytest.fixture(scope="module")
def rows(spark):
    # Document 1: pages 1-3 with two columns, page 4 with three, pages 6-7 with two.
    shape = {1: 2, 2: 2, 3: 2, 4: 3, 6: 2, 7: 2}
    data = [(1, p, p * 10 + r, [f"p{p}r{r}c{c}" for c in range(n)]) for p, n in shape.items() for r in range(2)]
    data.append((2, 1, 1, ["a & b", "<c>", "d|e"]))
    return spark.createDataFrame(data, "doc_id int, page_number int, row_no int, cells array<string>").cache()


def test_render(rows):
    html = T.render_tables(rows).where("doc_id = 2").first()
    assert html["content"] == "<table><tr><td>a &amp; b</td><td>&lt;c&gt;</td><td>d|e</td></tr></table>"
    md = T.render_tables(rows, "markdown").where("doc_id = 1 and page_number = 4").first()["content"]
    assert md == "| p4r0c0 | p4r0c1 | p4r0c2 |\n| --- | --- | --- |\n| p4r1c0 | p4r1c1 | p4r1c2 |"
    assert "d\\|e" in T.render_tables(rows, "markdown").where("doc_id = 2").first()["content"]
    with pytest.raises(ValueError):
        T.render_tables(rows, "latex")


@pytest.mark.parametrize("limits", [{}, {"min_rows": 1}])
def test_merge(rows, limits):
    got = T.merge_tables(T.render_tables(rows), **limits).orderBy("start_page").collect()
    assert [(r["start_page"], r["end_page"], r["pages_merged"], r["n_rows"], r["target_columns"]) for r in got] == [
        (1, 3, 3, 6, 2), (6, 7, 2, 4, 2),
    ]
    assert got[0]["merged_table_id"] == "merged_1_1"


@pytest.mark.parametrize("part", [1, 2, 1000])
def test_parts_concatenate_to_the_whole(rows, part):
    parts = T.merged_table_html(T.render_tables(rows), part_pages=part).orderBy("merged_table_id", "part_no").collect()
    whole = {}
    for r in parts:
        whole[r["merged_table_id"]] = whole.get(r["merged_table_id"], "") + r["merged_table_html"]
    assert whole["merged_1_6"] == "<table>" + "".join(
        f"<tr><td>p{p}r{r}c0</td><td>p{p}r{r}c1</td></tr>" for p in (6, 7) for r in (0, 1)
    ) + "</table>"
    assert set(whole) == {"merged_1_1", "merged_1_6"}


def test_summaries(spark, rows):
    assert T.summarize_tables(rows).where("summary is not null").count() == 0
    s = T.summarize_tables(rows, True).where("doc_id = 1 and page_number = 4").first()["summary"]
    assert s == "2 rows, 3 columns; first row: p4r0c0, p4r0c1, p4r0c2"
    f = spark.createDataFrame([("figure", "A tree. And more."), ("text", "x")], "fragment_type string, text string")
    assert [r["summary"] for r in T.summarize_figures(f, True).collect()] == ["A tree."]
    assert [r["summary"] for r in T.summarize_figures(f).collect()] == [None]


def test_cells_of_a_text_line(spark):
    df = spark.createDataFrame([("| a | b|c |",), ("a | b",)], "t string")
    assert [r[0] for r in df.select(T.table_cells_of("t")).collect()] == [["a", "b", "c"], ["a", "b"]]


def test_dataset_analytics_adds_up(spark):
    states = ["failure", "pending", "pending", "successful", "processing", "detecting_layout", "formatted_output"]
    df = spark.createDataFrame([(1, s) for s in states], "dataset_id int, status string")
    r = A.dataset_analytics(df).first()
    assert tuple(r)[1:] == (3, 2, 1, 1, 7)


def test_progress_keeps_null(spark):
    jobs = spark.createDataFrame([(1,), (2,)], "parse_id int")
    tasks = spark.createDataFrame([(1, True), (1, False)], "parse_id int, done boolean")
    got = {r["parse_id"]: tuple(r)[1:] for r in A.progress(jobs, tasks).collect()}
    assert got == {1: (1, 2, 0.5), 2: (None, None, None)}


def test_meter(spark):
    df = spark.createDataFrame(
        [(1, 1, "signature"), (1, 1, "signature"), (1, 2, "text"), (1, 3, "strikethrough")],
        "doc_id int, page_number int, fragment_type string",
    )
    assert tuple(A.meter(df).first())[1:] == (3, 1, 1)


def log(spark, rows):
    return spark.createDataFrame(rows, "entity_id int, ts_us bigint, status string, owner int")


def test_status_log(spark):
    d = log(spark, [
        (1, 0, "pending", 7), (1, 10, "running", 7), (1, 20, "suspended", 7), (1, 30, "running", 7), (1, 40, "terminated", 7),
        (2, 0, "pending", 8), (2, 5, "terminated", 8), (3, 0, "pending", 7), (3, 90, "running", 7), (4, 0, "terminated", 7), (4, 5, "pending", 7),
    ])
    t = {r["entity_id"]: tuple(r)[1:] for r in ST.time_to_state(d).collect()}
    assert t[1] == (0, 10, 10, None) and t[3] == (0, 90, 90, None)
    assert t[2] == t[4] == (None, None, None, ST.ENDED_EARLY)
    quiet = ST.time_to_state(log(spark, [(5, 3, "pending", 1), (6, 4, "running", 1)])).orderBy("entity_id").collect()
    assert [tuple(r)[1:] for r in quiet] == [(None, None, None, ST.NEVER_READY), (0, 0, 0, None)]
    for limits in ({}, {"min_rows": 1}):
        bad = ST.audit_transitions(d, **limits).collect()
        assert [(r["entity_id"], r["prev_status"], r["status"]) for r in bad] == [(4, "terminated", "pending")]
    w = {r["entity_id"]: (r["outcome"], r["waited"]) for r in ST.await_status(d, "running", 50).collect()}
    assert w == {1: ("ready", 10), 2: ("terminated", None), 3: ("timed_out", None), 4: ("terminated", None)}
    assert {r["entity_id"] for r in ST.list_entities(d, owner=7, status="terminated").collect()} == {1}
    assert ST.list_entities(d).count() == 4
    assert d.where(F.col("owner") == 8).count() == 2
