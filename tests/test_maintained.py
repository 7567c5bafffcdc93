"""Flags over many clocks and marts kept up to date, against full rebuilds."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casekit.operators import clocks, marts
from casekit.plans import catalogue, maintain
from casekit.plans.pipeline import build_all
from casekit.sources import bindings
from tests import fixture_cases

SF = "/root/testdata/sf0.001"


def bits(df):
    return sorted(str([x.hex() if isinstance(x, float) else x for x in r]) for r in df.collect())


@pytest.mark.parametrize("step", [24, 5])
def test_flag_counts_equal_the_fact_built_at_each_clock(spark, step):
    raw = bindings.raw_tables(spark, SF)
    fact = build_all(spark, raw, as_of=bindings.AS_OF)["fct_case_lifecycle"].cache()
    start, n = dt.datetime(1998, 5, 28, 23, 59, 59), 6
    got = {(r.clock, r.case_type): (r.late_cases, r.stale_cases, r.open_cases)
           for r in clocks.flag_counts(fact, str(start), n, step).collect()}
    assert len(got) == 5 * n
    for i in range(n):
        at = start + dt.timedelta(hours=step * i)
        for r in build_all(spark, raw, as_of=at)["fct_case_lifecycle"].groupBy("case_type").agg(
                F.expr("count_if(sla_breach_flag) late"), F.expr("count_if(stale_case_flag) stale"),
                F.expr(f"count_if(created_at <= TIMESTAMP_NTZ '{at}' AND (resolved_at IS NULL "
                       f"OR resolved_at > TIMESTAMP_NTZ '{at}')) open")).collect():
            assert got[at, r.case_type] == (r.late, r.stale, r.open)


def test_flags_begin_at_the_exact_clock(spark):
    rows = [(1, "a", dt.datetime(2024, 1, 1, 10, 59), None, None, None),
            (2, "a", dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 2, 0, 0), 1, None),
            (3, "a", None, None, None, None), (4, None, dt.datetime(2024, 1, 1), None, None, dt.datetime(2024, 1, 9))]
    fact = spark.createDataFrame(rows, "case_id int, case_type string, created_at timestamp_ntz, "
                                       "resolved_at timestamp_ntz, days_to_resolution bigint, last_interaction_at timestamp_ntz")
    got = {(r.case_type, r.clock): r for r in clocks.flag_counts(fact, "2024-01-01 00:00:00", 24 * 12, 1).collect()}
    stale = [c for (t, c), r in sorted(got.items(), key=str) if t == "a" and r.stale_cases]
    assert min(stale) == dt.datetime(2024, 1, 3, 11)  # 49 boundaries after the 10 o'clock hour
    late = [c for (t, c), r in got.items() if t == "a" and r.late_cases]
    assert min(late) == dt.datetime(2024, 1, 9)
    opened = {c: r.open_cases for (t, c), r in got.items() if t == "a"}
    assert opened[dt.datetime(2024, 1, 1, 10)] == 1 and opened[dt.datetime(2024, 1, 1, 11)] == 2
    assert opened[dt.datetime(2024, 1, 2)] == 1
    assert got[None, dt.datetime(2024, 1, 11, 0)].stale_cases == 0  # touched on the ninth
    assert got[None, dt.datetime(2024, 1, 11, 1)].stale_cases == 1


def test_maintained_marts_equal_a_rebuild_after_any_change(spark):
    fact = catalogue.models(spark, SF)["fct_case_lifecycle"].cache()
    advocates = catalogue.models(spark, SF)["stg_advocates"]
    # Inserts, deletes, updates in every summed column, and a doubled row.
    new = (
        fact.where("pmod(hash(case_id), 11) <> 3")
        .withColumn("status", F.expr("if(pmod(hash(case_id), 7) = 1, 'resolved', status)"))
        .withColumn("csat_score", F.expr("if(pmod(hash(case_id), 5) = 2, csat_score / 3 + 0.1, csat_score)"))
        .withColumn("hours_to_first_response", F.expr("if(pmod(hash(case_id), 5) = 1, NULL, hours_to_first_response / 7)"))
        .withColumn("case_type", F.expr("if(pmod(hash(case_id), 13) = 1, NULL, case_type)"))
    )
    new = new.union(fact.where("pmod(hash(case_id), 9) = 1").withColumn("case_id", F.expr("case_id + 1000000000")))
    new = new.union(new.where("pmod(hash(case_id), 17) = 4")).cache()
    changes = maintain.fact_changes(fact, new).cache()
    for mart, build in ((maintain.OPS_KPIS, marts.ops_kpis), (maintain.BOTTLENECKS, marts.bottlenecks)):
        state = mart.state(fact)
        assert bits(mart.finish(state)) == bits(build(fact).select(*mart.finish(state).columns))
        assert not mart.needs_rebuild(state)
        kept = maintain.maintain(mart, state, changes)
        assert bits(mart.finish(kept)) == bits(build(new).select(*mart.finish(kept).columns))
        back = maintain.maintain(mart, kept, maintain.fact_changes(new, fact))
        assert bits(mart.finish(back)) == bits(mart.finish(state))
    kept = maintain.maintain(maintain.ACTIVE_CASES, maintain.ACTIVE_CASES.state(fact), changes)
    got = marts.caseload_of(advocates, maintain.ACTIVE_CASES.finish(kept))
    assert bits(got) == bits(marts.advocate_caseload(advocates, new))


def test_changes_hold_only_cases_that_differ(spark):
    fact = build_all(spark, fixture_cases.raw_frames(spark), as_of=fixture_cases.AS_OF)["fct_case_lifecycle"].cache()
    assert maintain.fact_changes(fact, fact).count() == 0
    one = fact.first().case_id
    new = fact.where(f"case_id <> {one}")
    rows = maintain.fact_changes(fact, new).collect()
    assert {(r.case_id, r[maintain.SIGN]) for r in rows} == {(one, -1)}
    gone = maintain.maintain(maintain.OPS_KPIS, maintain.OPS_KPIS.state(fact),
                             maintain.fact_changes(fact, fact.limit(0)))
    assert gone.count() == 0  # groups without rows are gone


def test_plain_doubles_ask_for_a_rebuild(spark):
    fact = build_all(spark, fixture_cases.raw_frames(spark), as_of=fixture_cases.AS_OF)["fct_case_lifecycle"]
    assert maintain.OPS_KPIS.needs_rebuild(
        maintain.OPS_KPIS.state(fact.withColumn("csat_score", F.lit(float("inf")))))
