"""Marts M9–M11 over the case fact.

All three are aggregations whose group counts are small next to the fact;
Spark runs them as partial (map-side) + final hash aggregates, so only a few
rows per task cross the shuffle however skewed the grouping key is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.functions.exact import exact_avg_sql, int_avg_sql
from casekit.functions.exprs import count_where_sql, pct_sql, ratio_sql, round2_sql

# Status domains used by the reference's marts and dashboard.
CLOSED_STATUSES = ["resolved", "reopened"]
OPEN_STATUSES = ["open", "in_progress", "pending_docs", "escalated"]


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


IS_ACTIVE = f"status NOT IN ({_in_list(CLOSED_STATUSES)})"    # NULL status: not active
IS_CLOSED = f"status IN ({_in_list(CLOSED_STATUSES)})"
IS_OPEN = f"status IN ({_in_list(OPEN_STATUSES)})"


def _agg(*exprs: str):
    return [F.expr(e) for e in exprs]


def ops_kpis(fact: DataFrame) -> DataFrame:
    """M9: eleven KPIs per case type in one aggregation pass."""
    active = count_where_sql(IS_ACTIVE)
    return fact.groupBy("case_type").agg(*_agg(
        "count(1) AS total_cases",
        f"{active} AS active_cases",
        f"{active} AS open_backlog",
        f"{round2_sql(exact_avg_sql('hours_to_first_response'))} AS avg_hours_to_first_response",
        f"{round2_sql(int_avg_sql('days_to_resolution'))} AS avg_days_to_resolution",
        f"{round2_sql(pct_sql(count_where_sql('escalation_flag'), 'count(1)'))} AS escalation_rate_pct",
        f"{round2_sql(pct_sql(count_where_sql('reopen_flag'), count_where_sql(IS_CLOSED)))} AS reopen_rate_pct",
        f"{round2_sql(pct_sql(count_where_sql('sla_breach_flag'), 'count(1)'))} AS sla_breach_rate_pct",
        f"{round2_sql(int_avg_sql('interaction_count'))} AS avg_interactions_per_case",
        f"{round2_sql(exact_avg_sql('csat_score'))} AS avg_csat",
        f"{count_where_sql('stale_case_flag')} AS stale_cases_count",
    ))


def reopen_rate(fact: DataFrame) -> DataFrame:
    """F5 + A9: reopened share of closed cases per case type (NULL when none closed)."""
    closed, reopened = count_where_sql(IS_CLOSED), count_where_sql("reopen_flag")
    return fact.groupBy("case_type").agg(*_agg(
        f"{closed} AS closed_cases",
        f"{reopened} AS reopened_cases",
        f"{round2_sql(pct_sql(reopened, closed))} AS reopen_rate_pct",
    ))


def advocate_caseload(stg_advocates: DataFrame, fact: DataFrame) -> DataFrame:
    """Active cases and utilisation per advocate (every advocate kept).

    The fact is aggregated by advocate *before* the join: the reference's
    advocates ⟕ fact would shuffle every fact row to the advocate's reducer
    (one reducer per hot advocate, and a left outer join cannot broadcast the
    fact).  Pre-aggregation ships one partial count per advocate per task;
    the join is then dimension-sized and AQE may broadcast the aggregate once
    it has measured it.  Grouping by the five advocate columns afterwards
    keeps the reference's result when the dimension has repeated rows.
    """
    return caseload_of(stg_advocates, fact.groupBy("advocate_id").agg(
        F.expr(f"{count_where_sql(f'{IS_ACTIVE} AND case_id IS NOT NULL')} AS active")
    ))


def caseload_of(stg_advocates: DataFrame, per_advocate: DataFrame) -> DataFrame:
    """M10 from (advocate_id, active): every advocate with its count and ratio."""
    a = stg_advocates.selectExpr("id AS advocate_id", "name", "team", "specialty", "capacity")
    active = "coalesce(sum(active), 0L)"
    return (
        a.join(per_advocate, "advocate_id", "left")
        .groupBy("advocate_id", "name", "team", "specialty", "capacity")
        .agg(*_agg(
            f"{active} AS active_cases",
            f"{round2_sql(ratio_sql(active, 'capacity'))} AS utilization_ratio",
        ))
    )


# Bottleneck analysis labels.
MISSING_DOCS = "missing_docs_vs_resolution"
HANDOFFS = "handoffs_vs_csat"
CASE_TYPE = "case_type_vs_sla_breach"

HANDOFF_BUCKET = (
    "CASE WHEN handoff_count <= 1 THEN '0-1_handoffs' "
    "WHEN handoff_count = 2 THEN '2_handoffs' ELSE '3+_handoffs' END"
)


def _bottleneck_rows(fact: DataFrame, *more: str) -> DataFrame:
    """Tag each fact row with the (analysis, key) groups it belongs to.

    One scan of the fact feeds all three analyses: each row is expanded to
    at most three tagged copies (like GROUPING SETS' Expand) inside the scan
    stage, then one partial + final aggregation computes every segment.  The
    missing-docs analysis groups by the boolean itself (a NULL flag is its
    own group, labelled like false), so the key is the flag's text.
    """
    tags = (
        "inline(array("
        f"named_struct('analysis_type', '{MISSING_DOCS}', 'group_key', CAST(missing_docs AS STRING),"
        " 'keep', resolved_at IS NOT NULL),"
        f"named_struct('analysis_type', '{HANDOFFS}', 'group_key', {HANDOFF_BUCKET},"
        " 'keep', csat_score IS NOT NULL),"
        f"named_struct('analysis_type', '{CASE_TYPE}', 'group_key', case_type, 'keep', true)))"
    )
    return (
        fact.selectExpr("days_to_resolution", "csat_score", "sla_breach_flag", *more, tags)
        .filter("keep")
        .drop("keep")
    )


def bottlenecks(fact: DataFrame) -> DataFrame:
    """The three bottleneck analyses in one six-column table (UNION ALL)."""
    agg = _bottleneck_rows(fact).groupBy("analysis_type", "group_key").agg(*_agg(
        "count(1) AS case_count",
        f"{int_avg_sql('days_to_resolution')} AS _days",
        f"{exact_avg_sql('csat_score')} AS _csat",
        f"{pct_sql(count_where_sql('sla_breach_flag'), 'count(1)')} AS _sla",
    ))
    return agg.selectExpr(*bottleneck_columns("case_count", "_days", "_csat", "_sla"))


def bottleneck_columns(count: str, days: str, csat: str, sla: str) -> tuple[str, ...]:
    """M11's six columns from a group's count, means and breach share."""
    return (
        "analysis_type",
        f"CASE WHEN analysis_type = '{MISSING_DOCS}' THEN "
        "CASE WHEN group_key = 'true' THEN 'missing_docs' ELSE 'docs_complete' END "
        "ELSE group_key END AS segment",
        f"{count} AS case_count",
        f"{round2_sql(days)} AS avg_days_to_resolution",
        f"CAST(CASE WHEN analysis_type <> '{CASE_TYPE}' THEN {round2_sql(csat)} END AS DOUBLE) AS avg_csat",
        f"CAST(CASE WHEN analysis_type = '{CASE_TYPE}' THEN {round2_sql(sla)} END AS DOUBLE) AS sla_breach_pct",
    )


_BRANCHES = {
    # analysis -> (row filter, grouping expression, segment label of the group key)
    MISSING_DOCS: ("resolved_at IS NOT NULL", "missing_docs",
                   "CASE WHEN missing_docs THEN 'missing_docs' ELSE 'docs_complete' END"),
    HANDOFFS: ("csat_score IS NOT NULL", f"{HANDOFF_BUCKET} AS segment", "segment"),
    CASE_TYPE: ("true", "case_type", "case_type"),
}


def bottleneck_branch(fact: DataFrame, analysis_type: str) -> DataFrame:
    """One analysis of M11 on its own (M11a/b/c): filter, group, aggregate once."""
    where, key, segment = _BRANCHES[analysis_type]
    is_case_type = analysis_type == CASE_TYPE
    agg = fact.filter(where).groupBy(F.expr(key)).agg(*_agg(
        "count(1) AS case_count",
        f"{int_avg_sql('days_to_resolution')} AS _days",
        f"{exact_avg_sql('csat_score')} AS _csat",
        f"{pct_sql(count_where_sql('sla_breach_flag'), 'count(1)')} AS _sla",
    ))
    return agg.selectExpr(
        f"'{analysis_type}' AS analysis_type",
        f"{segment} AS segment",
        "case_count",
        f"{round2_sql('_days')} AS avg_days_to_resolution",
        ("CAST(NULL AS DOUBLE)" if is_case_type else round2_sql("_csat")) + " AS avg_csat",
        (round2_sql("_sla") if is_case_type else "CAST(NULL AS DOUBLE)") + " AS sla_breach_pct",
    )
