"""The plan properties PLANS.md claims, checked on the registered queries."""

import pytest

from eventloom.plans.catalog import QUERIES

from conftest import SF_SMALL


def _plan(spark, name):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # no "..." in scan metadata
    try:
        return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def _shuffles(plan):
    return [x for x in plan.splitlines() if "Exchange hashpartitioning" in x or "Exchange rangepartitioning" in x
            or "Exchange SinglePartition" in x or "Exchange RoundRobin" in x]


@pytest.mark.parametrize("name", ["batch_payload", "event_batches", "batch_assign"])
def test_uncut_batching_shuffles_once(spark, name):
    shuffles = _shuffles(_plan(spark, name))
    assert len(shuffles) == 1 and "_pkey" in shuffles[0]


def test_cut_batching_regroups_on_the_owner_hash(spark):
    plan = _plan(spark, "file_receipts")
    hashed = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(hashed) == 2 and "_tkey" in hashed[0] and "_pkey" in hashed[1]
    # anything else exchanged is the small per-split owner table (one row per file split)
    others = [x for x in _shuffles(plan) if "hashpartitioning" not in x]
    assert all("SinglePartition" in x for x in others)


@pytest.mark.parametrize("name", ["search_time_range", "search_predicate", "search_stats", "search_page"])
def test_search_bounds_reach_the_scan(spark, name):
    plan = _plan(spark, name)
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


def test_search_page_is_a_bounded_top_k(spark):
    plan = _plan(spark, "search_page")
    assert "TakeOrderedAndProject(limit=35, offset=10" in plan and "CollectLimit" not in plan


@pytest.mark.parametrize("name,columns", [
    ("event_metadata", "struct<event_id:bigint,event_type:string>"),
    ("format_event_map", "struct<event_id:bigint,ts:timestamp_ntz,props:string>"),
    ("search_stats", "struct<ts:timestamp_ntz,event_type:string,value:double>"),
])
def test_scans_read_only_used_columns(spark, name, columns):
    assert f"ReadSchema: {columns}" in _plan(spark, name)


def test_python_only_in_delivery(spark):
    for name in sorted(set(QUERIES) - {"stream_delivery", "stream_file_delivery", "stream_receipts"}):
        plan = _plan(spark, name)
        has_python = "MapInPandas" in plan or "ArrowEvalPython" in plan or "BatchEvalPython" in plan
        assert has_python == (name in {"delivery_receipts", "file_receipts"}), name
