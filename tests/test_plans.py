"""Physical-plan guards for the scale properties (checked on sf0.001)."""

import re

import pytest

import __spark_entry__ as E
from sf_dirs import SF_SMALL

BATCH = sorted(n for n in E.queries() if not re.match(r"stream_|op\d+_|pipeline$", n))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_or_nested_loop(spark, name):
    p = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["ad_quota_passed", "ad_quota_alerts", "hot_items", "hot_items_fine_top",
                                  "strict_pairs", "order_paid"])
def test_partial_group_limit_before_shuffle(spark, name):
    p = _plan(E.queries()[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def _scan_columns(plan: str) -> list[set]:
    import re
    return [{c.split("#")[0] for c in m.group(1).split(",")}
            for m in re.finditer(r"FileScan parquet \[([^\]]*)\]", plan)]


def test_scans_are_pruned_and_filtered(spark):
    p = _plan(E.queries()["hot_items"](spark, SF_SMALL))
    assert _scan_columns(p) == [{"ts", "event_type", "props"}]
    assert "PushedFilters: [IsNotNull(event_type)" in p and "(event_type#" in p
    p = _plan(E.queries()["tx_match"](spark, SF_SMALL))
    assert sorted(map(sorted, _scan_columns(p))) == [["l_orderkey", "l_shipdate"], ["o_orderdate", "o_orderkey"]]


def test_order_patterns_push_the_two_kinds_of_events(spark):
    p = _plan(E.queries()["order_paid"](spark, SF_SMALL))
    assert "PushedFilters: []" not in p and "Or(EqualTo(event_type,signup),EqualTo(event_type,purchase))" in p


@pytest.mark.parametrize("name", ["fail_runs", "fail_bursts"])
def test_building_a_query_starts_no_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", "build only")
    try:
        E.queries()[name](spark, SF_SMALL)
        jobs = [j for j in tracker.getJobIdsForGroup(f"build-{name}")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # schema inference of the Parquet footers is the only job there may be
    assert len(jobs) <= 1
