"""M8: one row per case with feedback, SLA-breach and stale flags.

The clock is a parameter (``as_of``, zone-less).  The flags are fixed when
the fact is built, exactly like a stored table: the date for the SLA test is
``as_of``'s date, the hour test counts hour boundaries up to ``as_of``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.functions.exprs import days_between_sql, hour_boundaries_sql

# The reference's SLA and staleness thresholds.
SLA_DAYS = 7
STALE_HOURS = 48

FACT_COLUMNS = [
    "case_id", "patient_id", "advocate_id", "case_type", "urgency", "status",
    "created_at", "assigned_at", "first_response_at", "resolved_at",
    "escalation_flag", "reopen_flag", "handoff_count", "complexity", "missing_docs",
    "hours_to_first_response", "days_to_resolution", "interaction_count",
    "last_interaction_at", "avg_interaction_duration_minutes", "csat_score",
    "nps_bucket", "sla_breach_flag", "stale_case_flag",
]


def as_of_sql(as_of: str | dt.datetime | None) -> str:
    """A clock argument as a TIMESTAMP_NTZ SQL literal (default: the local now)."""
    if as_of is None:
        return "localtimestamp()"
    if isinstance(as_of, dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return f"TIMESTAMP_NTZ '{as_of}'"


def sla_breach_sql(now: str, sla_days: int = SLA_DAYS) -> str:
    """Resolved in more than ``sla_days`` calendar days, or open past them."""
    return (
        f"((resolved_at IS NOT NULL AND days_to_resolution > {sla_days})"
        f" OR (resolved_at IS NULL AND {days_between_sql('created_at', now)} > {sla_days}))"
    )


def stale_sql(now: str, stale_hours: int = STALE_HOURS) -> str:
    """Unresolved and more than ``stale_hours`` hour boundaries since the last touch
    (or since creation when there was no touch)."""
    return (
        "(resolved_at IS NULL AND ("
        f"(last_interaction_at IS NULL AND {hour_boundaries_sql('created_at', now)} > {stale_hours})"
        f" OR (last_interaction_at IS NOT NULL"
        f" AND {hour_boundaries_sql('last_interaction_at', now)} > {stale_hours})))"
    )


def case_lifecycle(
    timings: DataFrame,
    stg_feedback: DataFrame,
    as_of: str | dt.datetime | None = None,
    sla_days: int = SLA_DAYS,
    stale_hours: int = STALE_HOURS,
) -> DataFrame:
    """timings ⟕ feedback on case_id (may fan out, as in the reference) + flags."""
    now = as_of_sql(as_of)
    fb = stg_feedback.select("case_id", "csat_score", "nps_bucket")
    base = timings.join(fb, "case_id", "left")
    return base.selectExpr(
        *FACT_COLUMNS[:8],
        "coalesce(first_response_at_event, first_response_at_case) AS first_response_at",
        *FACT_COLUMNS[9:22],
        f"{sla_breach_sql(now, sla_days)} AS sla_breach_flag",
        f"{stale_sql(now, stale_hours)} AS stale_case_flag",
    )


def feedback_duplicates(stg_feedback: DataFrame) -> DataFrame:
    """Cases with more than one feedback row (these fan out the fact)."""
    return (
        stg_feedback.groupBy("case_id")
        .agg(F.expr("count(1) AS feedback_rows"))
        .filter("feedback_rows > 1")
    )
