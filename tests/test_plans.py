"""Physical-plan properties the design relies on at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from casekit.plans import catalogue

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    yield lambda: [spark.conf.set(k, "-1") for k in keys]
    for k, v in old.items():
        spark.conf.set(k, v)


def test_fact_shuffles_each_input_once_on_case_id(spark, no_broadcast):
    no_broadcast()
    plan = _plan(entry.queries()["case_lifecycle"](spark, SF))
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, \d+\)", plan)
    assert len(exchanges) == 4, plan
    assert set(exchanges) == {"case_id"}
    assert plan.count("SortMergeJoin") == 3


def test_caseload_preaggregates_before_the_dimension_join(spark, no_broadcast):
    no_broadcast()
    plan = _plan(entry.queries()["advocate_caseload"](spark, SF))
    # the fact side reaches the advocate join as a (partial + final) aggregate
    join_at = plan.index("SortMergeJoin [advocate_id")
    assert "partial_count" in plan[join_at:]


def test_event_log_needs_no_shuffle(spark):
    plan = _plan(entry.queries()["event_log_ids"](spark, SF))
    assert "Exchange" not in plan


def test_scans_are_pruned(spark):
    plan = _plan(entry.queries()["ops_kpis"](spark, SF))
    orders_scan = [l for l in plan.split("\n") if "orders.parquet" in l][0]
    assert "o_totalprice" not in orders_scan
    assert "json_tuple" not in plan            # unused metadata is not parsed


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - {
    "csv_round_trip", "table_round_trip", "mart_ready", "pipeline_all",
    "stream_first_response", "stream_interaction_stats", "stream_case_timings"}))
def test_no_python_udf_in_plans(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "PythonUDF" not in plan


def test_bucketed_staging_makes_the_fact_shuffle_free(spark, no_broadcast):
    """Stored, bucketed staging tables co-locate every case_id join."""
    from casekit.plans.catalogue import models as build_models
    from casekit.plans.pipeline import persist_layers, scratch_path

    m = build_models(spark, SF)
    staged = {k: m[k] for k in ["stg_cases", "stg_case_events", "stg_interactions", "stg_feedback"]}
    persist_layers(spark, staged, "bucketed", scratch_path(spark, "bucketed"), buckets=8)
    no_broadcast()
    stored = {k: spark.table(f"bucketed_staging.{k}") for k in staged}
    from casekit.operators.lifecycle import case_lifecycle
    from casekit.operators.timings import case_timings

    fact = case_lifecycle(case_timings(stored["stg_cases"], stored["stg_case_events"],
                                       stored["stg_interactions"]), stored["stg_feedback"],
                          "1998-06-15 12:30:00")
    plan = _plan(fact)
    assert "Exchange" not in plan, plan
    direct = m["fct_case_lifecycle"]
    assert fact.count() == direct.count()
    assert fact.exceptAll(direct).count() == 0 and direct.exceptAll(fact).count() == 0


def test_buckets_grow_with_the_input_and_are_one_file_each(spark, monkeypatch):
    """A task that joins a bucket of each table must not grow with the tables."""
    from casekit.plans import pipeline
    from casekit.sources import bindings

    raw = bindings.raw_tables(spark, SF)
    assert pipeline.bucket_count(spark, raw) == 4
    monkeypatch.setattr(pipeline, "BUCKET_BYTES", 20_000)
    buckets = pipeline.bucket_count(spark, raw)
    assert buckets > 8
    spread = catalogue.models(spark, SF)["stg_interactions"].repartition(5)
    path = pipeline.scratch_path(spark, "bucket-files")
    pipeline.persist_layers(spark, {"stg_interactions": spread}, "bucketfiles", path, buckets)
    kept = spark.table("bucketfiles_staging.stg_interactions")
    assert len(kept.inputFiles()) <= buckets and kept.exceptAll(spread).count() == 0
    assert kept.count() == spread.count()
    spark.sql("DROP DATABASE bucketfiles_staging CASCADE")
