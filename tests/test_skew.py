"""A case holding a third of all interactions: AQE splits it, results stay whole."""

from __future__ import annotations

import pytest

from casekit.operators.eventlog import touches_before_resolution
from casekit.operators.timings import interaction_stats
from casekit.plans.catalogue import models as build_models

SF = "/root/testdata/sf0.01"
HOT_CASE = 7

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_inputs(spark):
    """Interactions with a third of the rows moved to one case.

    The test file is a single row group (one scan task); AQE splits a skewed
    reducer partition by ranges of map outputs, so the input is spread over
    8 map tasks first, as a table of many files would be.
    """
    m = build_models(spark, SF)
    inter = m["stg_interactions"].repartition(8).selectExpr(
        f"CASE WHEN pmod(id, 3) = 0 THEN {HOT_CASE}L ELSE case_id END AS case_id",
        "created_at", "duration_minutes")
    return inter, m["stg_cases"]


def test_hot_case_join_is_split_and_whole(spark, skew_conf):
    inter, cases = _hot_inputs(spark)
    hot_rows = inter.filter(f"case_id = {HOT_CASE}").count()
    assert hot_rows * 3 >= inter.count() * 0.9            # about a third of all rows
    result = touches_before_resolution(inter, cases)
    rows = {r.case_id: r.touches_before_resolution for r in result.collect()}
    final_plan = result._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final_plan, final_plan
    # brute force on the same inputs, without the join optimisation
    resolved = {r.id: r.resolved_at for r in cases.select("id", "resolved_at").collect()}
    expected = {}
    for r in inter.select("case_id", "created_at").collect():
        if r.case_id in resolved:
            res = resolved[r.case_id]
            if res is None or (r.created_at is not None and r.created_at < res):
                expected[r.case_id] = expected.get(r.case_id, 0) + 1
    assert rows == expected


def test_hot_case_aggregate_is_combined_map_side(spark, skew_conf):
    inter, _ = _hot_inputs(spark)
    stats = interaction_stats(inter)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    got = {r.case_id: r.interaction_count for r in stats.collect()}
    assert got[HOT_CASE] == inter.filter(f"case_id = {HOT_CASE}").count()
