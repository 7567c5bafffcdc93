
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from casekit.operators import marts
from casekit.operators.lifecycle import feedback_duplicates
from casekit.plans.catalogue import models as build_models

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def m(spark):
    return build_models(spark, SF, materialize_fact=True)


def test_fact_has_a_row_per_case_and_answer(m):
    """J3 fans out by the answers beyond a case's first one, and only by them."""
    more = feedback_duplicates(m["stg_feedback"].join(
        m["stg_cases"].selectExpr("id AS case_id"), "case_id", "left_semi"))
    extra = more.agg(F.sum(F.col("feedback_rows") - 1)).first()[0]
    assert extra > 0
    assert m["fct_case_lifecycle"].count() == m["stg_cases"].count() + extra


def test_kpi_totals_sum_to_fact_rows(m):
    total = m["mart_ops_kpis"].agg(F.sum("total_cases")).first()[0]
    assert total == m["fct_case_lifecycle"].count()


def test_caseload_active_matches_fact(m):
    fact = m["fct_case_lifecycle"]
    adv_ids = m["stg_advocates"].select(F.col("id").alias("advocate_id"))
    expected = fact.filter(marts.IS_ACTIVE).join(adv_ids, "advocate_id", "left_semi").count()
    got = m["mart_advocate_caseload"].agg(F.sum("active_cases")).first()[0]
    assert got == expected


def test_bottleneck_case_type_counts_equal_kpi_totals(m):
    b = {r.segment: r.case_count for r in
         marts.bottleneck_branch(m["fct_case_lifecycle"], marts.CASE_TYPE).collect()}
    k = {r.case_type: r.total_cases for r in m["mart_ops_kpis"].collect()}
    assert b == k


def test_branch_coverage_matches_fixture_notes(m):
    """FIXTURES.md §2 branch counts at sf0.01."""
    fact = m["fct_case_lifecycle"].dropDuplicates(["case_id"])
    st = {r.status: r["count"] for r in fact.groupBy("status").count().collect()}
    assert st == {"open": 3966, "in_progress": 2594, "pending_docs": 2494, "escalated": 1013,
                  "resolved": 4547, "reopened": 386}
    res = fact.filter(F.col("resolved_at").isNotNull())
    assert res.filter("sla_breach_flag").count() == 3205
    unres = fact.filter(F.col("resolved_at").isNull())
    assert unres.filter("sla_breach_flag").count() == 5263
    assert unres.filter("stale_case_flag AND last_interaction_at IS NOT NULL").count() == 1226
    assert unres.filter("stale_case_flag AND last_interaction_at IS NULL").count() == 96
    assert fact.filter("interaction_count = 0").count() == 257


def test_single_pass_bottlenecks_equal_the_three_branches(m):
    fact = m["fct_case_lifecycle"]
    one_pass = sorted(tuple(r) for r in marts.bottlenecks(fact).collect())
    branches = []
    for a in (marts.MISSING_DOCS, marts.HANDOFFS, marts.CASE_TYPE):
        branches += [tuple(r) for r in marts.bottleneck_branch(fact, a).collect()]
    assert one_pass == sorted(branches)
