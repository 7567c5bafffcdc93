"""Golden micro fixture (FIXTURES.md §3): hand-derived expected rows."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys

import pytest

from casekit.operators import marts, reports
from casekit.plans.pipeline import build_all
from casekit.sources import files
from tests import fixture_cases as fx

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def models(spark):
    return build_all(spark, fx.raw_frames(spark), as_of=fx.AS_OF)


def _by(rows, key):
    return {r[key]: r for r in rows}


EXPECTED_FACT = {
    # case_id: (hours_to_first_response, days_to_resolution, interaction_count,
    #           avg_interaction_duration_minutes, csat, sla_breach, stale)
    1: (3.0, 8, 0, None, 3.4, True, False),
    2: (12.5, 7, 2, 15.0, 2.0, False, False),
    3: (None, None, 0, None, None, True, True),
    4: (2.0, None, 1, 5.0, None, False, True),
    5: (None, None, 1, 0.0, None, False, False),
}


def _check_fact(fact_rows):
    got = _by(fact_rows, "case_id")
    assert set(got) == set(EXPECTED_FACT)
    for cid, exp in EXPECTED_FACT.items():
        r = got[cid]
        actual = (r.hours_to_first_response, r.days_to_resolution, r.interaction_count,
                  r.avg_interaction_duration_minutes, r.csat_score, r.sla_breach_flag,
                  r.stale_case_flag)
        assert actual == exp, (cid, actual, exp)


def test_fact(models):
    fact = models["fct_case_lifecycle"]
    assert fact.columns[-2:] == ["sla_breach_flag", "stale_case_flag"]
    assert len(fact.columns) == 24
    _check_fact(fact.collect())


def test_staging_defaults_and_trim(models):
    c = _by(models["stg_cases"].collect(), "id")
    assert c[1].urgency == "high"
    assert (c[3].handoff_count, c[3].complexity, c[3].missing_docs) == (0, "medium", True)
    assert (c[5].handoff_count, c[5].complexity, c[5].missing_docs, c[5].intake_source) == (0, "medium", False, "")
    assert c[5].barriers_json == "[]" and c[1].barriers_json == '["language","none"]'
    assert c[3].first_response_at is None and c[3].resolved_at is None
    a = _by(models["stg_advocates"].collect(), "id")
    assert a[1].name == "Ann Lee"


EXPECTED_KPIS = {
    # case_type: total, active, backlog, hours, days, esc%, reopen%, sla%, interactions, csat, stale
    "billing_dispute": (1, 1, 1, None, None, 100.0, None, 0.0, 1.0, None, 0),
    "claim_denial": (2, 2, 2, 2.0, None, 0.0, None, 50.0, 0.5, None, 2),
    "prior_authorization": (2, 0, 0, 7.75, 7.5, 50.0, 50.0, 50.0, 1.0, 2.7, 0),
}


def test_ops_kpis(models):
    got = _by(models["mart_ops_kpis"].collect(), "case_type")
    assert set(got) == set(EXPECTED_KPIS)
    for ct, exp in EXPECTED_KPIS.items():
        assert tuple(got[ct])[1:] == exp, (ct, tuple(got[ct]))


def test_caseload_and_over_capacity(models):
    cl = _by(models["mart_advocate_caseload"].collect(), "advocate_id")
    assert {k: (v.active_cases, v.utilization_ratio) for k, v in cl.items()} == {
        1: (0, 0.0), 2: (2, 2.0), 3: (1, None), 4: (0, 0.0)}
    over = reports.over_capacity(models["mart_advocate_caseload"]).collect()
    assert [r.advocate_id for r in over] == [2]
    assert [(r.team, r.name) for r in over] == [("resolution", "Bo Chan")]


EXPECTED_BOTTLENECKS = {
    ("missing_docs_vs_resolution", "missing_docs"): (1, 8.0, 3.4, None),
    ("missing_docs_vs_resolution", "docs_complete"): (1, 7.0, 2.0, None),
    ("handoffs_vs_csat", "3+_handoffs"): (1, 8.0, 3.4, None),
    ("handoffs_vs_csat", "0-1_handoffs"): (1, 7.0, 2.0, None),
    ("case_type_vs_sla_breach", "prior_authorization"): (2, 7.5, None, 50.0),
    ("case_type_vs_sla_breach", "claim_denial"): (2, None, None, 50.0),
    ("case_type_vs_sla_breach", "billing_dispute"): (1, None, None, 0.0),
}


def test_bottlenecks(models):
    rows = models["mart_bottlenecks"].collect()
    got = {(r.analysis_type, r.segment): (r.case_count, r.avg_days_to_resolution, r.avg_csat,
                                          r.sla_breach_pct) for r in rows}
    assert got == EXPECTED_BOTTLENECKS
    assert models["mart_bottlenecks"].columns == [
        "analysis_type", "segment", "case_count", "avg_days_to_resolution", "avg_csat", "sla_breach_pct"]


def test_headline_and_urgency(spark, models):
    fact = models["fct_case_lifecycle"]
    h = reports.exec_headline(fact).collect()[0]
    assert (h.active_cases, h.avg_days_to_resolution, h.sla_breach_rate_pct, h.avg_csat, h.stale_cases) == (
        3, 7.5, 40.0, 2.7, 2)
    txt = reports.metric_text(reports.exec_headline(fact)).collect()[0]
    assert (txt.avg_days_text, txt.sla_breach_rate_text, txt.avg_csat_text) == ("7.5", "40.0", "2.70")
    u = reports.open_by_urgency(spark, fact).collect()
    assert [(r.urgency, r.open_cases) for r in u] == [("high", 1), ("medium", 1), ("low", 1)]
    stale = reports.stale_cases(fact).collect()
    assert [r.case_id for r in stale] == [3, 4]


def test_dashboard_groupings(models):
    fact = models["fct_case_lifecycle"]
    md = {r.missing_docs: (r.avg_days_to_resolution, r.case_count)
          for r in reports.missing_docs_vs_resolution(fact).collect()}
    assert md == {True: (8.0, 1), False: (7.0, 1)}
    hc = {r.handoff_count: (r.avg_csat, r.case_count) for r in reports.handoffs_vs_csat(fact).collect()}
    assert hc == {3: (3.4, 1), 1: (2.0, 1)}
    es = {r.escalation_flag: (r.sla_breach_rate, r.case_count) for r in reports.escalation_vs_sla(fact).collect()}
    assert es == {True: (0.5, 2), False: (1 / 3, 3)}
    ed = {r.case_type: (r.escalated_cases, r.case_count, r.escalation_rate_pct)
          for r in reports.escalation_distribution(fact).collect()}
    assert ed["billing_dispute"] == (1, 1, 100.0) and ed["claim_denial"] == (0, 2, 0.0)
    comp = {r.advocate_id: (r.name, r.avg_days) for r in
            reports.advocate_comparison(fact, models["stg_advocates"]).collect()}
    assert comp == {1: ("Ann Lee", 7.5)}


def test_csv_extracts_give_same_fact(spark, tmp_path):
    """CRLF lines, quoted JSON with doubled quotes, blank timestamps, padded text."""
    fx.write_csv_files(str(tmp_path))
    raw = files.read_raw_tables(spark, str(tmp_path), "csv")
    m = build_all(spark, raw, as_of=fx.AS_OF)
    _check_fact(m["fct_case_lifecycle"].collect())
    fb = _by(m["stg_feedback"].collect(), "id")
    assert fb[1].feedback_text == "thanks, great"


def test_csv_round_trip_exact(spark, tmp_path):
    """S13 + S1: write raw tables as CSV and read back without loss (microseconds kept)."""
    raw = fx.raw_frames(spark)
    files.write_raw_tables(raw, str(tmp_path))
    back = files.read_raw_tables(spark, str(tmp_path), "csv")
    a = build_all(spark, raw, as_of=fx.AS_OF)["fct_case_lifecycle"].orderBy("case_id").collect()
    b = build_all(spark, back, as_of=fx.AS_OF)["fct_case_lifecycle"].orderBy("case_id").collect()
    assert a == b


def test_event_log(models):
    from casekit.operators.eventlog import event_log

    ev = event_log(models["stg_cases"]).orderBy("case_id", "seq").collect()
    c1 = [(r.seq, r.event_type) for r in ev if r.case_id == 1]
    assert c1 == [(1, "opened"), (2, "assigned"), (3, "first_response"), (4, "docs_requested"),
                  (5, "docs_received"), (6, "resolved")]
    c3 = [(r.seq, r.event_type, r.occurred_at) for r in ev if r.case_id == 3]
    assert c3[2] == (3, "first_response", dt.datetime(2024, 2, 22, 22, 0))
    assert c3[3] == (4, "docs_requested", dt.datetime(2024, 2, 23, 0, 0))
    assert len(c3) == 4


def test_table_helpers(spark, models):
    from pyspark.sql import types as T

    from casekit.plans.pipeline import layer_path, persist_layers, scratch_path

    location = scratch_path(spark, "golden")
    rows = persist_layers(spark, {"mart_ops_kpis": models["mart_ops_kpis"]}, "golden", location)
    assert rows == {"mart_ops_kpis": 3}
    tables = {"mart_ops_kpis": "golden_marts.mart_ops_kpis"}
    assert files.mart_ready(spark, layer_path(location, "golden", "mart_ops_kpis"))
    assert not files.mart_ready(spark, layer_path(location, "golden", "mart_bottlenecks"))
    empty = files.table_or_empty(spark, "golden_marts.no_such_mart",
                                 T.StructType([T.StructField("case_type", T.StringType())]))
    assert empty.count() == 0 and empty.columns == ["case_type"]
    schema = T.StructType([T.StructField("case_type", T.StringType())])
    q_missing = files.query_or_empty(spark, "SELECT case_type FROM golden_marts.nope", schema)
    assert q_missing.count() == 0 and q_missing.columns == ["case_type"]
    q_ok = files.query_or_empty(spark, f"SELECT case_type FROM {tables['mart_ops_kpis']}", schema)
    assert q_ok.count() == 3
    import pytest as _pytest
    from pyspark.errors import AnalysisException
    with _pytest.raises(AnalysisException):
        files.query_or_empty(spark, f"SELECT no_such_column FROM {tables['mart_ops_kpis']}", schema)
    assert spark.table(tables["mart_ops_kpis"]).count() == 3


def test_persisted_layers_read_the_previous_layer(spark):
    """A full refresh stores every model; marts are computed from the stored fact."""
    from casekit.plans.pipeline import persist_layers, scratch_path

    m = build_all(spark, fx.raw_frames(spark), as_of=fx.AS_OF)
    rows = persist_layers(spark, m, "layered", scratch_path(spark, "layered"))
    assert len(rows) == 11 and rows["fct_case_lifecycle"] == 5
    plan = m["mart_ops_kpis"]._jdf.queryExecution().optimizedPlan().toString()
    assert "fct_case_lifecycle" in plan or "layered_marts" in plan
    got = {r.case_type: r.total_cases for r in spark.table("layered_marts.mart_ops_kpis").collect()}
    assert got == {"billing_dispute": 1, "claim_denial": 2, "prior_authorization": 2}


def test_thresholds_are_parameters(spark):
    """SLA days and stale hours are parameters with the reference's defaults (7, 48)."""
    m = build_all(spark, fx.raw_frames(spark), as_of=fx.AS_OF, sla_days=8, stale_hours=47)
    got = {r.case_id: (r.sla_breach_flag, r.stale_case_flag) for r in m["fct_case_lifecycle"].collect()}
    assert got[1] == (False, False)      # 8 days is no longer a breach
    assert got[3] == (False, True)       # 8 calendar days open: not > 8
    assert got[5] == (False, True)       # exactly 48 boundaries > 47


def test_default_clock_is_now(spark):
    """Without as_of the flags use the current time (all five cases are old by now)."""
    m = build_all(spark, fx.raw_frames(spark))
    got = {r.case_id: (r.sla_breach_flag, r.stale_case_flag) for r in m["fct_case_lifecycle"].collect()}
    assert got[3] == (True, True) and got[4] == (True, True) and got[5] == (True, True)


def test_command_line_run_and_report(spark, tmp_path, capsys):
    """`run` stores the layers, twice over the same place; `report` reads them back."""
    from casekit.__main__ import main, report

    raw, layers = str(tmp_path / "raw"), str(tmp_path / "layers")
    os.mkdir(raw)
    fx.write_csv_files(raw)
    for _ in range(2):
        assert main(["run", "--raw", raw, "--location", layers, "--as-of", fx.AS_OF, "--prefix", "cli"], spark) == 0
    assert "mart_ops_kpis\t3" in capsys.readouterr().out
    h = report(spark, "exec_headline", layers, "cli").collect()[0]
    assert (h.active_cases, h.avg_days_to_resolution, h.stale_cases) == (3, 7.5, 2)
    u = report(spark, "open_by_urgency", layers, "cli").collect()
    assert [(r.urgency, r.open_cases) for r in u] == [("high", 1), ("medium", 1), ("low", 1)]
    assert main(["report", "kpi_table", "--location", layers, "--prefix", "cli"], spark) == 0
    assert len(capsys.readouterr().out.splitlines()) == 4


def test_layers_outlive_the_process(tmp_path):
    """`run` and `report` as two processes, as the README shows them; a rerun replaces."""
    raw, layers, out = (str(tmp_path / n) for n in ("raw", "layers", "out"))
    os.mkdir(raw)
    fx.write_csv_files(raw)
    env = dict(os.environ, PYTHONPATH=ROOT, PYSPARK_SUBMIT_ARGS="--master local[2] --driver-memory 1g "
               "--conf spark.driver.host=127.0.0.1 --conf spark.ui.enabled=false pyspark-shell")

    def casekit(*args):
        return subprocess.run([sys.executable, "-m", "casekit", *args], cwd=tmp_path, env=env, check=True,
                              capture_output=True, text=True, timeout=300).stdout.splitlines()

    for buckets in ("2", "3"):
        casekit("run", "--raw", raw, "--location", layers, "--as-of", fx.AS_OF, "--buckets", buckets)
    got = casekit("report", "kpi_table", "--location", layers)
    assert got[0].startswith("case_type,total_cases") and len(got) == 4
    casekit("report", "caseload_table", "--location", layers, "--output", out)
    assert any(n.endswith(".csv") for n in os.listdir(out))


def test_command_line_reads_parquet_raw(spark, tmp_path):
    from casekit.__main__ import main, report
    from casekit.sources.files import RAW_FILES

    for table, df in fx.raw_frames(spark).items():
        df.write.parquet(str(tmp_path / f"{table}.parquet"))
    assert set(RAW_FILES) == set(fx.raw_frames(spark))
    layers = str(tmp_path / "layers")
    assert main(["run", "--raw", str(tmp_path), "--format", "parquet", "--as-of", fx.AS_OF,
                 "--location", layers, "--prefix", "cliparquet", "--buckets", "4"], spark) == 0
    kpis = {r.case_type: r.total_cases for r in report(spark, "kpi_table", layers, "cliparquet").collect()}
    assert kpis == {"billing_dispute": 1, "claim_denial": 2, "prior_authorization": 2}


def test_report_without_stored_layers_says_so(spark, tmp_path):
    import pytest as _pytest

    from casekit.__main__ import REPORTS, report

    assert len(REPORTS) >= 15                      # D1–D15 (+ metric text, reopen rate)
    with _pytest.raises(SystemExit, match="run the pipeline first"):
        report(spark, "kpi_table", str(tmp_path / "never_built"))
