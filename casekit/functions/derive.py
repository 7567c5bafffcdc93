"""Column rules the reference's data simulator applies (E25–E34), as operators.

Only the deterministic parts are kept (no random draws): they run as plain
SQL expressions over real case rows.  Arguments are column names or SQL
expression text; ``*_sql`` variants return text for composition.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casekit.functions.json import json_fields_sql, metadata_columns_sql

# Base resolution days per case type and the per-handoff increment.
BASE_RESOLUTION_DAYS = {
    "prior_authorization": 8,
    "claim_denial": 9,
    "billing_dispute": 4,
    "provider_search": 5,
    "care_coordination": 6,
}
DAYS_PER_HANDOFF = 0.5
MIN_EXPECTED_DAYS = 1.0
# Expected CSAT model.
CSAT_BASE = 4.0
CSAT_ESCALATED = 0.6
CSAT_REOPENED = 0.8
CSAT_PER_HANDOFF = 0.15
CSAT_MIN, CSAT_MAX = 1.0, 5.0
# NPS cut-offs.
NPS_PROMOTER = 4.5
NPS_PASSIVE = 3.5
# Barrier filtering.
NO_BARRIER = "none"
SUPPORTED_BARRIERS = ["language", "transportation"]


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def nps_bucket_sql(score: str) -> str:
    return (f"CASE WHEN {score} >= {NPS_PROMOTER}D THEN 'promoter' "
            f"WHEN {score} >= {NPS_PASSIVE}D THEN 'passive' ELSE 'detractor' END")


def clamp_sql(x: str, lo: float, hi: float) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN greatest({lo}D, least({hi}D, {x})) END"


def derive_status(status: str, resolved_at: str, reopen_flag: str) -> Column:
    """A resolution time means resolved (or reopened); otherwise the open status."""
    return F.expr(
        f"CASE WHEN {resolved_at} IS NOT NULL THEN "
        f"CASE WHEN {reopen_flag} THEN 'reopened' ELSE 'resolved' END ELSE {status} END"
    )


def expected_days(case_type: str, handoff_count: str) -> Column:
    """Base days of the case type + 0.5 per handoff, at least 1 (NULL for unknown types)."""
    pairs = ", ".join(f"'{k}', {float(v)}D" for k, v in BASE_RESOLUTION_DAYS.items())
    raw = f"(try_element_at(map({pairs}), {case_type}) + {handoff_count} * {DAYS_PER_HANDOFF}D)"
    return F.expr(f"CASE WHEN {raw} IS NOT NULL THEN greatest({MIN_EXPECTED_DAYS}D, {raw}) END")


def expected_csat_sql(escalation_flag: str, reopen_flag: str, handoff_count: str) -> str:
    raw = (f"({CSAT_BASE}D - CASE WHEN {escalation_flag} THEN {CSAT_ESCALATED}D ELSE 0D END"
           f" - CASE WHEN {reopen_flag} THEN {CSAT_REOPENED}D ELSE 0D END"
           f" - {handoff_count} * {CSAT_PER_HANDOFF}D)")
    return clamp_sql(raw, CSAT_MIN, CSAT_MAX)


def expected_csat(escalation_flag: str, reopen_flag: str, handoff_count: str) -> Column:
    """4.0 - 0.6 if escalated - 0.8 if reopened - 0.15 per handoff, clamped to [1, 5]."""
    return F.expr(expected_csat_sql(escalation_flag, reopen_flag, handoff_count))


def cap_at(ts: str, now_sql: str) -> Column:
    """A timestamp no later than ``now`` (NULL stays NULL)."""
    return F.expr(f"CASE WHEN {ts} IS NOT NULL THEN least({ts}, {now_sql}) END")


def clean_barriers_sql(barriers: str) -> str:
    return (f"CASE WHEN size({barriers}) > 1 "
            f"THEN filter({barriers}, x -> NOT (x <=> '{NO_BARRIER}')) ELSE {barriers} END")


def support_flags_sql(barriers: str) -> str:
    return f"filter({barriers}, x -> x IN ({_quoted(SUPPORTED_BARRIERS)}))"


def metadata_document_sql(intake_source: str, barriers: str, handoff_count: str,
                          complexity: str, submitted_documents: str, support: str,
                          missing_docs: str) -> str:
    return (
        "to_json(named_struct("
        f"'intake_source', {intake_source}, 'barriers', {barriers}, "
        f"'handoff_count', {handoff_count}, 'complexity', {complexity}, "
        f"'submitted_documents', {submitted_documents}, 'support_flags', {support}, "
        f"'missing_docs', {missing_docs}))"
    )


def parse_document(df, doc: str, keep: list[str]):
    """The document in column ``doc`` parsed back with staging's defaults.

    Returns ``df`` reduced to ``keep`` + the seven typed metadata columns.
    """
    parsed = df.selectExpr(*keep, json_fields_sql(doc, "_d_"))
    return parsed.selectExpr(*keep, *[f"{sql} AS {name}" for name, sql in metadata_columns_sql("_d_").items()])
