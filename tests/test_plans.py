"""Plan guards for the report queries, on the plan Spark would use when no
side is small enough to broadcast (threshold off, AQE off): no cartesian
or nested-loop joins, no Python evaluation, partial aggregation ahead of
every aggregate shuffle, and parquet scans pruned to the needed columns."""

import re

import pytest

from stagewise.plans import analysis_queries as aq
from stagewise.plans import fixture_queries as fq

from .conftest import SF_SMALL

LOAD_PATH = {"landing_csv", "create_or_merge", "incremental_two_batches", "incremental_two_batches_bucketed",
             "landing_stream", "empty_table_first_merge", "incremental_same_stamp", "load_rejects", "top_open_states",
             "funnel_rollup_state", "funnel_rollup_conversion_by_age"}
MERGE_KEYS = sorted(k for k in fq.QUERIES if k.startswith("merge_"))
REPORT_KEYS = sorted(k for k in fq.QUERIES if k not in LOAD_PATH and not k.startswith("merge_"))


@pytest.fixture(scope="module")
def big_plan_spark(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", REPORT_KEYS)
def test_report_plan_shape(big_plan_spark, key):
    plan = _plan(fq.QUERIES[key](big_plan_spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{key}: {bad}"
    # Every grouped aggregate directly above a planner-inserted hash exchange
    # is a final aggregate whose partial (map-side) half sits below it. (The
    # catalog's explicit repartition on client_id is the one shuffle that
    # serves both its de-duplication and the join, so it is exempt.)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if ("Exchange hashpartitioning" in line and "ENSURE_REQUIREMENTS" in line and i > 0
                and "HashAggregate" in lines[i - 1]):
            below = "\n".join(lines[i + 1:i + 4])
            assert "HashAggregate" in below and ("partial_" in below or "functions=[]" in below), key
    for schema in re.findall(r"ReadSchema: (struct<[^>]*>)", plan):
        assert "c_acctbal" not in schema and "o_totalprice" not in schema, f"{key}: unpruned scan {schema}"


@pytest.mark.parametrize("key", ["dedupe_latest", "ordered_funnel_state", "ordered_funnel_global", "catalog_history", "catalog_history_collapsed",
                                 "events_as_of", "survival_state", "time_quantiles", "stage_overlap", "propose_labels", "moved_clients"])
def test_plans_over_time(big_plan_spark, key):
    """Operators over time: no loops over pairs, no Python, and what is grouped is combined before the first shuffle."""
    plan = _plan(aq.QUERIES[key](big_plan_spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{key}: {bad}"
    assert "partial_" in plan
    for schema in re.findall(r"ReadSchema: (struct<[^>]*>)", plan):
        assert "c_acctbal" not in schema and "o_totalprice" not in schema, f"{key}: unpruned scan {schema}"


@pytest.mark.parametrize("key", MERGE_KEYS)
def test_merge_plan_shape(big_plan_spark, key):
    plan = _plan(fq.QUERIES[key](big_plan_spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{key}: {bad}"


def test_updating_merge_scans_and_shuffles_each_side_once(big_plan_spark, tmp_path):
    from stagewise.operators.merge import Insert, Update, merge

    spark = big_plan_spark
    for name in ("target", "source"):
        spark.range(100).selectExpr("id AS k", "id * 2 AS v").write.parquet(f"{tmp_path}/{name}")
    t, s = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("target", "source"))
    for on in (["k"], "t.k = s.k AND s.v > t.v"):
        plan = _plan(merge(t, s, on, Update(), Insert(), materialize_source=False))
        assert plan.count("FileScan parquet") == 2, plan
        assert plan.count("Exchange hashpartitioning") == 2, plan
        assert plan.count("FullOuter") == 1, plan


def test_pivot_is_one_aggregation_pass(big_plan_spark):
    plan = _plan(fq.QUERIES["pivot_stages"](big_plan_spark, SF_SMALL))
    assert plan.count("partial_min") >= 1
    assert "PivotFirst" not in plan
