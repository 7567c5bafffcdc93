"""M7: per-case timings (cases ⟕ first-response aggregate ⟕ interaction aggregate).

Plan shape at scale: both event tables are aggregated *before* the joins, so
each join is one-to-at-most-one on ``case_id`` and cannot fan out.  The
aggregates run partial-then-final, so a hot case (one key holding a large
share of events or interactions) collapses to one row per map task before the
shuffle.  All three inputs are hash-partitioned on ``case_id``; the two
aggregates' exchanges are reused by the joins, and the cases side is shuffled
once for both joins: three exchanges with broadcasts off (the fact's feedback
join adds a fourth, on the same key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.functions.exact import exact_avg_sql
from casekit.functions.exprs import days_between_sql, hours_between_sql

FIRST_RESPONSE_EVENT = "first_response"

TIMINGS_COLUMNS = [
    "case_id", "patient_id", "advocate_id", "case_type", "urgency", "status",
    "created_at", "assigned_at", "first_response_at_case", "first_response_at_event",
    "resolved_at", "escalation_flag", "reopen_flag", "handoff_count", "complexity",
    "missing_docs", "hours_to_first_response", "days_to_resolution",
    "interaction_count", "last_interaction_at", "avg_interaction_duration_minutes",
]


def first_response_min(stg_case_events: DataFrame, name: str = "first_response_at") -> DataFrame:
    """A1: earliest first_response event per case."""
    return (
        stg_case_events.filter(F.col("event_type") == FIRST_RESPONSE_EVENT)
        .groupBy("case_id")
        .agg(F.expr(f"min(occurred_at) AS {name}"))
    )


def interaction_stats(stg_interactions: DataFrame) -> DataFrame:
    """A2: touches, last touch and mean duration per case."""
    return stg_interactions.groupBy("case_id").agg(
        F.expr("count(1) AS interaction_count"),
        F.expr("max(created_at) AS last_interaction_at"),
        F.expr(f"{exact_avg_sql('duration_minutes')} AS avg_duration_minutes"),
    )


def case_timings(
    stg_cases: DataFrame, stg_case_events: DataFrame, stg_interactions: DataFrame
) -> DataFrame:
    return timings_from_aggregates(
        stg_cases,
        first_response_min(stg_case_events, "first_response_at_event"),
        interaction_stats(stg_interactions),
    )


def timings_from_aggregates(stg_cases: DataFrame, first_response: DataFrame,
                            stats: DataFrame) -> DataFrame:
    """M7 from already-aggregated event tables (one row per case each).

    ``first_response``: (case_id, first_response_at_event); ``stats``:
    (case_id, interaction_count, last_interaction_at, avg_duration_minutes).
    The batch model passes fresh aggregates; the streaming path passes the
    merged incremental partials, so the fact can be refreshed without
    rescanning the event history.
    """
    fr = first_response
    c = stg_cases.selectExpr(
        "id AS case_id", "patient_id", "advocate_id", "case_type", "urgency", "status",
        "created_at", "assigned_at", "first_response_at AS first_response_at_case",
        "resolved_at", "escalation_flag", "reopen_flag", "handoff_count", "complexity",
        "missing_docs",
    )
    joined = c.join(fr, "case_id", "left").join(stats, "case_id", "left")
    first_response = "coalesce(first_response_at_event, first_response_at_case)"
    return joined.selectExpr(
        *TIMINGS_COLUMNS[:16],
        f"{hours_between_sql('created_at', first_response)} AS hours_to_first_response",
        f"CASE WHEN resolved_at IS NOT NULL THEN {days_between_sql('created_at', 'resolved_at')} END"
        " AS days_to_resolution",
        "coalesce(interaction_count, 0L) AS interaction_count",
        "last_interaction_at",
        "avg_duration_minutes AS avg_interaction_duration_minutes",
    )
