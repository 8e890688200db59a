"""What the plans must look like, whatever the data size."""

import re

import pytest

from docspark import workload

QUERIES = workload.queries()
STREAMS = {n for n in QUERIES if n.endswith("_stream") or n in ("set_2_replay_then_live", "udf_1_update_callback")}
PYTHON = {"udf_2_custom_extractor", "udf_3_summary_hook", "doc_19_request_configurations"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_bad_operators(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in PYTHON:
        assert "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name, column", [
    ("flt_3_list_jobs", "o_orderdate"), ("src_13_point_lookup", "o_orderkey"), ("srt_1_keyset_next", "o_orderdate"),
])
def test_filters_reach_the_scan(spark, sf_dir, name, column):
    pushed = re.findall(r"PushedFilters: \[(.*?)(?:\]|\.\.\.|$)", physical(QUERIES[name](spark, sf_dir)))
    assert any(column in p for p in pushed)


@pytest.mark.parametrize("name, columns", [
    ("agg_1_dataset_analytics", {"o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"}),
    ("agg_11_duplicates", {"text"}),
])
def test_only_needed_columns_are_read(spark, sf_dir, name, columns):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", physical(QUERIES[name](spark, sf_dir)))
    assert all({c.split(":")[0] for c in r.split(",")} <= columns for r in read)


@pytest.mark.parametrize("name", [
    "doc_1_split_pages", "doc_2_fragment_text", "doc_5_markdown", "doc_6_chunk_section", "doc_7_partition_patterns",
    "win_2_section_id", "win_3_header_path", "doc_11_citations", "doc_20_run_dataset", "doc_19_run_jobs",
])
def test_document_work_has_no_shuffle(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    exchanges = [x for x in re.findall(r"Exchange (\w+)", plan) if x != "RoundRobinPartitioning"]
    assert exchanges == []


def test_paging_is_a_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in physical(QUERIES["srt_1_keyset_next"](spark, sf_dir))
