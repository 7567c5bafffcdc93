"""Versions of the stored layers: atomic publishing, resuming, following the input."""

from __future__ import annotations

import shutil

import pytest

from casekit.plans import catalogue, versions
from casekit.plans.pipeline import Models
from casekit.sources import bindings
from tests import fixture_cases

SF = "/root/testdata/sf0.001"
MARTS = {"mart_ops_kpis", "mart_advocate_caseload", "mart_bottlenecks"}


def raw_of(spark, folder=SF):
    return bindings.raw_tables(spark, folder)


def kpis(layers):
    return sorted(map(tuple, layers["mart_ops_kpis"].collect()))


def test_a_killed_run_leaves_the_old_version_and_resumes(spark, tmp_path):
    location = str(tmp_path)
    first = versions.refresh(spark, raw_of(spark), location, bindings.AS_OF)
    assert first["version"] == 1 and not any(m["reused"] for m in first["models"].values())
    assert first["models"]["mart_ops_kpis"]["rows"] == 5
    before = kpis(versions.Version(spark, location))

    class Killed(Exception):
        pass

    def kill(name):
        if name == "fct_case_lifecycle":
            raise Killed

    with pytest.raises(Killed):
        versions.refresh(spark, raw_of(spark), location, bindings.AS_OF, sla_days=1, on_written=kill)
    reader = versions.Version(spark, location)
    assert reader.number == 1 and kpis(reader) == before  # the old version, whole
    written = []
    again = versions.refresh(spark, raw_of(spark), location, bindings.AS_OF, sla_days=1, on_written=written.append)
    assert set(written) == MARTS and again["version"] == 2
    assert kpis(versions.Version(spark, location)) != before
    assert kpis(reader) == before  # a report that began before goes on with its version
    # Nothing to do: nothing is written, the version stays.
    third = versions.refresh(spark, raw_of(spark), location, bindings.AS_OF, sla_days=1, on_written=written.append)
    assert third["version"] == 2 and len(written) == 3
    # Back to the first parameters: the ledger still has those models.
    back = versions.refresh(spark, raw_of(spark), location, bindings.AS_OF, on_written=written.append)
    assert back["version"] == 3 and len(written) == 3 and kpis(versions.Version(spark, location)) == before


def test_only_what_a_changed_input_reaches_is_rebuilt(spark, tmp_path):
    data, location = tmp_path / "in", str(tmp_path / "out")
    shutil.copytree(SF, data)
    versions.refresh(spark, raw_of(spark, str(data)), location, bindings.AS_OF)
    old = versions.Version(spark, location)
    n = old["stg_patients"].count()
    spark.read.parquet(f"{SF}/customer.parquet").limit(40).coalesce(1).write.parquet(str(tmp_path / "new"))
    part = next((tmp_path / "new").glob("part-*.parquet"))
    (data / "customer.parquet").chmod(0o644)
    shutil.copyfile(part, data / "customer.parquet")
    spark.catalog.refreshByPath(str(data))
    written = []
    versions.refresh(spark, raw_of(spark, str(data)), location, bindings.AS_OF, on_written=written.append)
    new = versions.Version(spark, location)
    assert new["stg_patients"].count() == 40 < n == old["stg_patients"].count()
    assert {"stg_patients", "stg_advocates", "mart_advocate_caseload"} <= set(written)
    assert not {"stg_case_events", "stg_interactions"} & set(written)


def test_expired_versions_go_and_unfinished_runs_stay(spark, tmp_path):
    location = str(tmp_path)
    for days in (1, 2, 3):
        versions.refresh(spark, raw_of(spark), location, bindings.AS_OF, sla_days=days)

    def stop(name):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        versions.refresh(spark, raw_of(spark), location, "1998-07-01 00:00:00", on_written=stop)
    removed = versions.expire(spark, location, keep=2)
    assert {r.split("-")[0] for r in removed} == MARTS | {"fct_case_lifecycle"}
    assert len(removed) == 5  # the fact's clustered copy as well
    assert set(versions.Version(spark, location)) == set(Models.NAMES)
    for name in Models.NAMES:
        assert versions.Version(spark, location)[name].count() >= 0
    # The run that died after its first new model takes it from the ledger.
    manifest = versions.refresh(spark, raw_of(spark), location, "1998-07-01 00:00:00")
    assert manifest["models"]["fct_case_lifecycle"]["reused"]
    assert versions.expire(spark, location, keep=1, grace=0) and len(kpis(versions.Version(spark, location))) == 5


def test_raw_tables_without_files_are_never_taken_for_equal(spark, tmp_path):
    raw = fixture_cases.raw_frames(spark)
    for version in (1, 2):
        manifest = versions.refresh(spark, raw, str(tmp_path), fixture_cases.AS_OF)
        assert manifest["version"] == version and not manifest["models"]["stg_cases"]["reused"]


def test_reports_and_streams_follow_a_replaced_input(spark, tmp_path):
    """The registered queries answer from the input as it is now."""
    data = tmp_path / "in"
    shutil.copytree(SF, data)
    q = catalogue.queries()
    names = ("kpi_table", "stream_first_response", "stream_interaction_stats")
    before = {n: sorted(map(str, q[n](spark, str(data)).collect())) for n in names}
    for file in data.iterdir():
        file.chmod(0o644)
        shutil.copyfile(f"/root/testdata/sf0.01/{file.name}", file)
    spark.catalog.refreshByPath(str(data))
    for n in names:
        now = sorted(map(str, q[n](spark, str(data)).collect()))
        want = sorted(map(str, q[n](spark, "/root/testdata/sf0.01").collect()))
        assert now == want != before[n], n
