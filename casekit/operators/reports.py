"""Report datasets D1–D15 (what the reference's dashboard shows).

The dashboard computes these in pandas after pulling the whole fact to one
process; here each is a DataFrame over the fact or a mart, so only the small
result ever leaves the cluster.  pandas rules are kept where they differ
from SQL: group-by drops NULL keys (T12), mean/sum skip NULL while ``len``
counts every row (T13), ``count`` ignores NULL (T14), and a reindex keeps
only the listed keys (T15).  Sorting happens only on these small results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casekit.functions.exact import exact_avg_sql, int_avg_sql
from casekit.functions.exprs import count_where_sql, fmt_number_sql, pct_sql
from casekit.operators.marts import IS_OPEN

# The urgency order of the "open cases by urgency" chart.
URGENCY_ORDER = ["high", "medium", "low"]
STALE_LIST_ROWS = 50
STALE_LIST_COLUMNS = ["case_id", "case_type", "urgency", "status", "created_at", "last_interaction_at"]
OVER_CAPACITY_RATIO = 1.0


def _agg(*exprs: str):
    return [F.expr(e) for e in exprs]


def exec_headline(fact: DataFrame) -> DataFrame:
    """One row of headline numbers (unrounded, as the page computes them)."""
    return fact.agg(*_agg(
        f"{count_where_sql(IS_OPEN)} AS active_cases",
        f"{int_avg_sql('days_to_resolution')} AS avg_days_to_resolution",
        f"{pct_sql(count_where_sql('sla_breach_flag'), 'count(1)')} AS sla_breach_rate_pct",
        f"{exact_avg_sql('csat_score')} AS avg_csat",
        f"{count_where_sql('stale_case_flag')} AS stale_cases",
    ))


def metric_text(headline: DataFrame) -> DataFrame:
    """The headline tiles as text (fixed decimals, a dash for NULL)."""
    return headline.selectExpr(
        "CAST(active_cases AS STRING) AS active_cases_text",
        f"{fmt_number_sql('avg_days_to_resolution', 1)} AS avg_days_text",
        f"{fmt_number_sql('sla_breach_rate_pct', 1)} AS sla_breach_rate_text",
        f"{fmt_number_sql('avg_csat', 2)} AS avg_csat_text",
        "CAST(stale_cases AS STRING) AS stale_cases_text",
    )


def backlog_by_case_type(kpis: DataFrame) -> DataFrame:
    """The two series of the backlog chart."""
    return kpis.select("case_type", "open_backlog", "active_cases")


def open_by_urgency(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """Open cases per urgency in the fixed order high, medium, low; zero-filled.

    Counts are filtered to the three-value domain before the join, so the
    broadcast side has at most three rows whatever the data size.
    """
    rows = ", ".join(f"named_struct('urgency', '{u}', 'position', {i})"
                     for i, u in enumerate(URGENCY_ORDER))
    domain = spark.range(1).selectExpr(f"inline(array({rows}))")
    in_domain = ", ".join(f"'{u}'" for u in URGENCY_ORDER)
    counts = (
        fact.filter(f"{IS_OPEN} AND urgency IN ({in_domain})")
        .groupBy("urgency")
        .agg(F.expr("count(1) AS n"))
    )
    return (
        domain.join(F.broadcast(counts), "urgency", "left")
        .selectExpr("urgency", "coalesce(n, 0L) AS open_cases", "position")
        .orderBy("position")
    )


def stale_cases(fact: DataFrame, rows: int = STALE_LIST_ROWS) -> DataFrame:
    """The stale-case list, first ``rows`` by case id (a top-k, not a sort)."""
    return (
        fact.filter("stale_case_flag")
        .select(*STALE_LIST_COLUMNS)
        .orderBy("case_id")
        .limit(rows)
    )


def over_capacity(caseload: DataFrame) -> DataFrame:
    """Advocates whose utilisation exceeds 1.0 (NULL ratio drops out)."""
    return caseload.filter(f"utilization_ratio > {OVER_CAPACITY_RATIO}D")


def escalation_distribution(fact: DataFrame) -> DataFrame:
    """Escalated count, non-null count and rate per case type."""
    escalated, flagged = count_where_sql("escalation_flag"), "count(escalation_flag)"
    return (
        fact.filter("case_type IS NOT NULL")
        .groupBy("case_type")
        .agg(*_agg(
            f"{escalated} AS escalated_cases",
            f"{flagged} AS case_count",
            f"{pct_sql(escalated, flagged)} AS escalation_rate_pct",
        ))
        .orderBy("case_type")
    )


def interaction_load(fact: DataFrame) -> DataFrame:
    """Mean touches and case count per case type."""
    return (
        fact.filter("case_type IS NOT NULL")
        .groupBy("case_type")
        .agg(*_agg(f"{int_avg_sql('interaction_count')} AS avg_interactions", "count(case_id) AS cases"))
        .orderBy("case_type")
    )


def missing_docs_vs_resolution(fact: DataFrame) -> DataFrame:
    """Resolution days by missing-docs flag (resolved cases only)."""
    return (
        fact.filter("resolved_at IS NOT NULL AND missing_docs IS NOT NULL")
        .groupBy("missing_docs")
        .agg(*_agg(f"{int_avg_sql('days_to_resolution')} AS avg_days_to_resolution",
                   "count(days_to_resolution) AS case_count"))
        .orderBy("missing_docs")
    )


def handoffs_vs_csat(fact: DataFrame) -> DataFrame:
    """CSAT by exact handoff count (rated cases only)."""
    return (
        fact.filter("csat_score IS NOT NULL AND handoff_count IS NOT NULL")
        .groupBy("handoff_count")
        .agg(*_agg(f"{exact_avg_sql('csat_score')} AS avg_csat", "count(case_id) AS case_count"))
        .orderBy("handoff_count")
    )


def escalation_vs_sla(fact: DataFrame) -> DataFrame:
    """SLA-breach rate (0..1) and case count by escalation flag."""
    return (
        fact.filter("escalation_flag IS NOT NULL")
        .groupBy("escalation_flag")
        .agg(*_agg(f"{int_avg_sql('CAST(sla_breach_flag AS INT)')} AS sla_breach_rate",
                   "count(case_id) AS case_count"))
        .orderBy("escalation_flag")
    )


def case_type_delay(fact: DataFrame) -> DataFrame:
    """Mean resolution days per case type."""
    return (
        fact.filter("days_to_resolution IS NOT NULL AND case_type IS NOT NULL")
        .groupBy("case_type")
        .agg(F.expr(f"{int_avg_sql('days_to_resolution')} AS avg_days_to_resolution"))
        .orderBy("case_type")
    )


def advocate_comparison(fact: DataFrame, stg_advocates: DataFrame) -> DataFrame:
    """Mean resolution days per advocate, with name and team.

    Aggregate first (one row per advocate), then an inner join with the
    dimension; both sides are dimension-sized, and AQE picks broadcast or
    sort-merge from their measured sizes.
    """
    per_advocate = (
        fact.filter("days_to_resolution IS NOT NULL")
        .groupBy("advocate_id")
        .agg(F.expr(f"{int_avg_sql('days_to_resolution')} AS avg_days"))
    )
    a = stg_advocates.selectExpr("id AS advocate_id", "name", "team")
    return per_advocate.join(a, "advocate_id", "inner").select(
        "advocate_id", "name", "team", "avg_days"
    )
