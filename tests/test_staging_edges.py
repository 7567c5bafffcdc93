"""Staging edge cases: TRIM (E1), malformed/blank JSON (T7, T20), blank CSV cells."""

from __future__ import annotations

import datetime as dt

import duckdb

from casekit import schemas
from casekit.operators.staging import stg_cases
from casekit.sources import files
from tests import fixture_cases as fx


def test_trim_removes_spaces_and_keeps_tabs(spark):
    vals = ["  a  ", "\ta\t", " \t a \t ", "", "   ", None]
    got = [r.t for r in spark.createDataFrame([(v,) for v in vals], "s string").selectExpr("trim(s) AS t").collect()]
    exp = [r[0] for r in duckdb.execute(
        "SELECT TRIM(s) FROM (SELECT unnest(?::VARCHAR[]) AS s, generate_subscripts(?::VARCHAR[], 1) AS i) ORDER BY i",
        [vals, vals]).fetchall()]
    assert got == exp
    assert got[1] == "\ta\t"


def _case(cid, meta):
    t = dt.datetime(2024, 1, 1)
    return (cid, cid, 1, "claim_denial", "low", "open", t, t, None, None, 0, 0, meta)


def test_json_leniency_and_defaults(spark):
    raw = spark.createDataFrame([
        _case(1, '{"handoff_count": "3", "missing_docs": "true", "complexity": " low "}'),
        _case(2, '{"handoff_count": 2.0, "missing_docs": true}'),
        _case(3, '{"handoff_count": 3.7}'),
        _case(4, "not json at all"),
        _case(5, ""),
        _case(6, '{"handoff_count": null, "complexity": null, "barriers": ["x", "y z"]}'),
        _case(7, '{"handoff_count": "many"}'),
    ], schemas.CASES)
    got = {r.id: (r.handoff_count, r.complexity, r.missing_docs, r.barriers_json)
           for r in stg_cases(raw).collect()}
    assert got[1] == (3, "low", True, "[]")
    assert got[2] == (2, "medium", True, "[]")
    assert got[3] == (4, "medium", False, "[]")          # text cast rounds like the reference
    assert got[4] == (0, "medium", False, "[]")          # malformed JSON: NULL -> defaults (T7)
    assert got[5] == (0, "medium", False, "[]")          # blank cell
    assert got[6] == (0, "medium", False, '["x","y z"]')  # JSON null = missing; arrays compact
    assert got[7] == (0, "medium", False, "[]")          # non-numeric text -> default, no error


def test_blank_csv_cells_are_null(spark, tmp_path):
    fx.write_csv_files(str(tmp_path))
    raw = files.read_raw_tables(spark, str(tmp_path), "csv")
    fb = {r.id: r for r in raw["patient_feedback"].collect()}
    assert fb[2].feedback_text is None
    cases = {r.id: r for r in raw["cases"].collect()}
    assert cases[3].first_response_at is None and cases[3].resolved_at is None
    assert cases[5].metadata_json is None
    assert cases[1].metadata_json.startswith('{"handoff_count": 3')


def test_metadata_rejects_counts_non_objects(spark):
    from casekit.operators.staging import metadata_rejects

    raw = spark.createDataFrame([
        _case(1, '{"a": 1}'), _case(2, "not json"), _case(3, ""), _case(4, "[1, 2]"),
        _case(5, None), _case(6, '{"handoff_count": 2}'),
    ], schemas.CASES)
    r = metadata_rejects(raw).collect()[0]
    assert (r.documents, r.rejected) == (5, 3)


def test_blank_and_padded_timestamps(spark):
    """Blank or whitespace-only text is NULL; 'T' and fractions parse."""
    t = dt.datetime(2024, 1, 1)
    rows = [
        (1, 1, 1, "x", "low", "open", t, t, "   ", "", 0, 0, None),
        (2, 2, 1, "x", "low", "resolved", t, t, "2024-01-01T12:00:00.250000", "2024-01-03 08:00:00", 0, 0, None),
    ]
    got = {r.id: (r.first_response_at, r.resolved_at) for r in stg_cases(spark.createDataFrame(rows, schemas.CASES)).collect()}
    assert got[1] == (None, None)
    assert got[2] == (dt.datetime(2024, 1, 1, 12, 0, 0, 250000), dt.datetime(2024, 1, 3, 8, 0))


def test_rebuilt_document_skips_non_json_array_text(spark):
    """Array fields are embedded verbatim; a bare string value leaves its key out."""
    from casekit.functions import derive

    raw = spark.createDataFrame([
        _case(1, '{"barriers": ["a", 1], "handoff_count": 2}'),
        _case(2, '{"barriers": "just text"}'),
    ], schemas.CASES)
    doc = derive.metadata_document_sql(
        "intake_source", "try_parse_json(barriers_json)", "handoff_count", "complexity",
        "try_parse_json(submitted_documents_json)", "try_parse_json(support_flags_json)", "missing_docs")
    got = {r.id: r.d for r in stg_cases(raw).selectExpr("id", f"{doc} AS d").collect()}
    assert '"barriers":["a",1]' in got[1]
    assert '"barriers"' not in got[2] and '"handoff_count":0' in got[2]
