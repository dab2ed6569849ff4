"""Plan properties the catalogue relies on at scale."""

from __future__ import annotations

from obslake.plans.catalogue import QUERIES
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reporting_window_and_columns_reach_the_scan(spark):
    df = QUERIES["period_metrics"](spark, SF_SMALL)
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(l_shipdate" in formatted and "LessThan(l_shipdate" in formatted
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>" in formatted


def test_dimension_is_broadcast_by_measured_size_without_hints(spark):
    plan = _plan(QUERIES["period_metrics"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["period_metrics"](spark, SF_SMALL))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_null_safe_upsert_match_is_an_equi_join(spark):
    plan = _plan(QUERIES["upsert_null_safe_key"](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
