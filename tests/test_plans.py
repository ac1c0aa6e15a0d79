"""Scale invariants read from the physical plans of the registered queries."""

import re

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
STREAMING = {"stream_ingest", "stream_questions", "stream_enrich"}


def _plan(spark, name):
    return entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - STREAMING))
def test_no_pairwise_joins(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["knn_topk", "knn_hydrated"])
def test_top_k_is_limited_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", _plan(spark, name))


@pytest.mark.parametrize("name", ["sentence_chunks", "chunk_records", "storage_gate", "clean_text", "articles", "keywords"])
def test_per_text_work_has_no_key_shuffle(spark, name):
    plan = _plan(spark, name)
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    # the chunk fold must run once: exactly one aggregate(...) fold expression
    if name in ("sentence_chunks", "chunk_records", "storage_gate"):
        assert plan.count("aggregate(") == 1


def test_hot_group_numbering_avoids_group_window(spark):
    plan = _plan(spark, "batch_assign")
    # the numbered rows are written once (range partitioning cuts anew in every plan), then read back
    assert "row-numbers" in plan and "_local_rn" in plan
    assert not re.search(r"Window \[row_number\(\)", plan)
