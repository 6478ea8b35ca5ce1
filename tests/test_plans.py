"""Plan checks: top-k without full sort, pruned scans, no Python UDFs, partial aggregation."""

import pytest

from trend_engine.plans.registry import QUERIES

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["top_viral_posts", "author_leaderboard", "trending_top20"])
def test_topk_is_take_ordered(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf(result, name):
    plan = _plan(result(name))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


# Source columns a query must not read (column pruning through the derivation and the aggregate).
UNREAD = {
    "tier_distribution": ["user_id", "event_type"],
    "tier_distribution_serving": ["user_id", "event_type"],
    "stats_summary": ["user_id", "event_type"],
    "store_audit": ["user_id", "event_type"],
    "top_viral_posts": ["user_id"],
    "windowed_topics": ["user_id"],
    "hourly_rollup": ["user_id"],
    "poll_summary": ["user_id"],
    "topic_leaderboard": ["user_id"],
    "trend_report": ["user_id"],
    "head_of_list": ["user_id", "value", "props"],
}


@pytest.mark.parametrize("name", sorted(UNREAD))
def test_scan_reads_only_needed_columns(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas
    for line in schemas:
        read = line.split("ReadSchema:")[1]
        for col in UNREAD[name]:
            assert f"{col}:" not in read, (name, col, read)


def test_latest_per_key_has_partial_aggregate(spark):
    plan = QUERIES["viral_posts_latest"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(result, name):
    plan = _plan(result(name))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["trend_report", "analytics_report", "trending_payload"])
def test_reports_reduce_the_posts_once(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # one scan for the posts (both branches share its shuffle), one for the counters of the polls
    assert plan.count("FileScan") == 2 and plan.count("ReusedExchange") == 1


def test_report_gathers_top_and_counter_rows_only(result):
    plan = _plan(result("trend_report"))
    assert "TakeOrderedAndProject(limit=3" in plan
    # posts reach the union as two flags; only top rows and counters carry values into the lists
    assert plan.count("collect_list") >= 2 and "null AS _top" in plan and "null AS _stat" in plan
