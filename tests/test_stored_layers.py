"""The layered run does all its work, and queries leave a user's tables alone."""

from __future__ import annotations

import csv
import io

import __spark_entry__ as entry
from casekit.__main__ import main
from casekit.operators import reports
from casekit.plans import catalogue
from casekit.plans.pipeline import LAYERS, StoredLayers, persist_layers, scratch_path

SF = "/root/testdata/sf0.001"


def test_layers_are_computed_in_full(spark):
    """Every model's own plan keeps its joins and the JSON parse."""
    m = catalogue.models(spark, SF)
    plan = m["fct_case_lifecycle"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 3 and "json_tuple" in plan
    location = scratch_path(spark, "full")
    rows = persist_layers(spark, m, "full", location, register=False)
    stored = StoredLayers(spark, location, "full")
    assert list(stored) == [n for names in LAYERS.values() for n in names]
    for name, df in stored.items():
        assert df.count() == rows[name]
        direct = catalogue.models(spark, SF)[name]
        assert df.exceptAll(direct).count() == 0 and direct.exceptAll(df).count() == 0, name


def test_pipeline_all_counts_what_it_wrote(spark):
    got = {r.model: r.row_count for r in entry.queries()["pipeline_all"](spark, SF).collect()}
    assert len(got) == 11 and got["fct_case_lifecycle"] > got["stg_cases"]  # feedback fans out


def test_reports_are_complete(spark, tmp_path, capsys):
    """More rows than any screen: all of them are printed, and written."""
    layers = str(tmp_path / "layers")
    persist_layers(spark, catalogue.models(spark, SF), "casekit", layers, register=False)
    stored = StoredLayers(spark, layers)
    want = {r.advocate_id for r in reports.advocate_comparison(
        stored["fct_case_lifecycle"], stored["stg_advocates"]).collect()}
    assert len(want) > 100
    assert main(["report", "advocate_comparison", "--location", layers], spark) == 0
    printed = list(csv.DictReader(io.StringIO(capsys.readouterr().out)))
    assert {int(r["advocate_id"]) for r in printed} == want and len(printed) == len(want)
    assert main(["report", "advocate_comparison", "--location", layers, "--output", str(tmp_path / "o")], spark) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "o")).count() == len(want)


def test_queries_leave_a_users_tables_unchanged(spark):
    location = scratch_path(spark, "users-own")
    persist_layers(spark, catalogue.models(spark, SF), "casekit", location)
    before = {t: spark.table(f"casekit_marts.{t}").collect() for t in LAYERS["marts"]}
    databases = {d.name for d in spark.catalog.listDatabases()}
    for name in ("table_round_trip", "mart_ready", "pipeline_all", "kpi_table", "csv_round_trip"):
        entry.queries()[name](spark, "/root/testdata/sf0.01").count()
    assert {t: spark.table(f"casekit_marts.{t}").collect() for t in LAYERS["marts"]} == before
    assert {d.name for d in spark.catalog.listDatabases()} == databases


def test_bound_inputs_exercise_the_operators(spark):
    """Many different documents, rejects, and cases with several answers."""
    m = catalogue.models(spark, SF)
    assert m["stg_cases"].select("barriers_json").distinct().count() >= 20
    q = entry.queries()
    rejects = q["metadata_rejects"](spark, SF).first()
    assert min(rejects.rejected, rejects.bad_handoff_count, rejects.bad_missing_docs) > 0
    assert q["metadata_reject_rows"](spark, SF).count() == (
        rejects.rejected + rejects.bad_handoff_count + rejects.bad_missing_docs)
    assert q["feedback_duplicates"](spark, SF).count() > 0
