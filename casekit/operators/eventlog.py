"""Case record -> event log (M12, W1) and the simulator's touch filters.

The event log is an unpivot: each case row yields up to six events through
``inline`` of an array of identically-shaped structs.  The per-case sequence
number is computed *inside the same row* (1 + the number of earlier events
present), so numbering needs no window and no shuffle: the whole operator is
a single narrow stage however many cases there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.operators.marts import IS_CLOSED

# Event types in the order the simulator emits them, and the
# fallback / offset rules for derived event times.
EVENT_ORDER = ["opened", "assigned", "first_response", "docs_requested", "docs_received", "resolved"]
FIRST_RESPONSE_FALLBACK_HOURS = 12
DOCS_REQUESTED_AFTER_HOURS = 2
DOCS_RECEIVED_BEFORE_DAYS = 1


def event_times_sql() -> list[str]:
    """Times of the six events for a staged case row (NULL = event absent)."""
    fr = (f"coalesce(first_response_at, assigned_at + "
          f"make_dt_interval(0, {FIRST_RESPONSE_FALLBACK_HOURS}))")
    return [
        "created_at",
        "assigned_at",
        fr,
        f"CASE WHEN missing_docs THEN {fr} + make_dt_interval(0, {DOCS_REQUESTED_AFTER_HOURS}) END",
        "CASE WHEN missing_docs AND resolved_at IS NOT NULL "
        f"THEN resolved_at - make_dt_interval({DOCS_RECEIVED_BEFORE_DAYS}) END",
        "resolved_at",
    ]


def event_log(stg_cases: DataFrame) -> DataFrame:
    """M12 + W1: (case_id, seq, event_type, occurred_at); (case_id, seq) is the event id."""
    times = event_times_sql()
    present = [f"CAST(({t}) IS NOT NULL AS BIGINT)" for t in times]
    structs = []
    for i, (name, t) in enumerate(zip(EVENT_ORDER, times)):
        seq = " + ".join(["1L", *present[:i]])
        structs.append(f"named_struct('event_type', '{name}', 'occurred_at', {t}, 'seq', {seq})")
    return (
        stg_cases.selectExpr("id AS case_id", f"inline(array({', '.join(structs)}))")
        .filter("occurred_at IS NOT NULL")
        .select("case_id", "seq", "event_type", "occurred_at")
    )


def feedback_eligible(raw_cases: DataFrame) -> DataFrame:
    """closed cases with a usable resolution time (present and not blank)."""
    return raw_cases.filter(
        f"{IS_CLOSED} AND resolved_at IS NOT NULL AND trim(CAST(resolved_at AS STRING)) <> ''"
    ).select("id", "status", "resolved_at")


def touches_before_resolution(stg_interactions: DataFrame, stg_cases: DataFrame) -> DataFrame:
    """per case, interactions strictly before its resolution (all of them if unresolved).

    An inner equi-join on case_id followed by an aggregation on the same key,
    so the join's hash partitioning is reused (no second shuffle).  A case
    with a huge share of interactions is streamed through the sort-merge join
    against its single case row; AQE's skew handling splits that partition.
    """
    c = stg_cases.selectExpr("id AS case_id", "resolved_at")
    i = stg_interactions.select("case_id", "created_at")
    return (
        i.join(c, "case_id", "inner")
        .filter("resolved_at IS NULL OR created_at < resolved_at")
        .groupBy("case_id")
        .agg(F.expr("count(1) AS touches_before_resolution"))
    )
