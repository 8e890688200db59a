"""Document code stays linear in the size of one document."""

import time

import pytest

from docspark.operators import chunks, pages
from docspark.operators import fragments as G
from docspark.plans import jobs
from docspark.plans.config import Configuration, ExtractionOptions


CITED = Configuration(extraction=(ExtractionOptions(
    "t", '{"type":"object","properties":{"total":{"type":"number"},"name":{"type":"string"}}}', partition_strategy="fragment", provide_citations=True),))


def seconds(run):
    best = float("inf")
    for _ in range(2):
        begin = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - begin)
    return best


@pytest.mark.parametrize("make,run", [
    (lambda n: "\f".join(f"page {i}" for i in range(n)), lambda df: pages.split_pages(df).count()),
    (lambda n: "\n".join(f"{'#' * (1 + i % 4)} h{i}\nbody" for i in range(n)),
     lambda df: chunks.header_path(G.with_fragments(pages.with_pages(df))).count()),
    (lambda n: "\n".join(f"total: {i % 7}\nsome words that make a line of text, which ends here {i}" for i in range(n // 5)),
     lambda df: jobs.assemble(jobs.run_dataset(df, CITED, "extract"), "doc_id").write.format("noop").mode("overwrite").save()),
])
def test_time_grows_with_the_document(spark, make, run):
    small, large = (spark.createDataFrame([(1, make(n))], "doc_id long, text string").cache() for n in (5_000, 20_000))
    small.count(), large.count()
    # Quadratic work would take sixteen times as long; the fixed cost of a query hides in the constant.
    assert seconds(lambda: run(large)) < 8 * seconds(lambda: run(small)) + 2


def test_header_paths_of_all_levels(spark):
    text = "\n".join(["Intro text, which ends with a full stop.", "### c1", "- x", "# A", "## B", "- y", "#### D", "- z", "## E", "# F", "- w"])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = chunks.header_path(G.with_fragments(pages.with_pages(df))).collect()
    path = {r.text: r.header_path for r in rows}
    top = "Intro text, which ends with a full stop."  # the first line is the title
    assert path["x"] == f"{top} > c1" and path["y"] == f"{top} > A > B" and path["z"] == f"{top} > A > B > D"
    assert path["w"] == f"{top} > F"


def test_form_feed_spans(spark):
    text = "ab\fé\f\fxyz"
    rows = pages.split_pages(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("page_number").collect()
    assert [(r.start, r.end, r.text) for r in rows] == [(0, 2, "ab"), (3, 4, "é"), (5, 5, ""), (6, 9, "xyz")]
