"""The query catalogue: ``queries()`` (Spark) and ``oracle_sql()`` (DuckDB).

Every query reads the driver's tables through the bindings and runs over
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casekit.functions import derive
from casekit.functions.exprs import text_to_int_sql
from casekit.functions.json import json_field_text_sql, text_array_sql
from casekit.operators import clocks, eventlog, marts, reports
from casekit.operators.lifecycle import feedback_duplicates
from casekit.operators.staging import metadata_reject_rows, metadata_rejects
from casekit.operators.timings import first_response_min, interaction_stats
from casekit.plans import maintain, oracle, versions
from casekit.plans.pipeline import LAYERS, bucket_count, build_all, layer_path, materialize, persist_layers, scratch_path
from casekit.session import checkpoint_dir
from casekit.sources import bindings, files, sniff
from casekit.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]


def models(spark: SparkSession, sf_dir: str, materialize_fact: bool = False) -> dict[str, DataFrame]:
    """All models over the bound test tables with the pinned clock (lazy)."""
    raw = bindings.raw_tables(spark, sf_dir)
    return build_all(spark, raw, as_of=bindings.AS_OF, materialize_fact=materialize_fact)


def stored_models(spark: SparkSession, sf_dir: str) -> versions.Version:
    """The stored layers of this input, brought up to date first.

    The reports read what a run stored, as the reference's page does.  Models
    whose inputs, parameters and code are unchanged are taken as they are; a
    replaced input file rebuilds what it reaches.
    """
    source = hashlib.sha256(sf_dir.encode()).hexdigest()[:16]
    location = f"{checkpoint_dir(spark).rstrip('/')}/casekit-layers/{source}"
    manifest = versions.refresh(spark, bindings.raw_tables(spark, sf_dir), location, bindings.AS_OF)
    return versions.Version(spark, location, manifest)


def _stored(name: str, fn: Callable[[DataFrame], DataFrame] = lambda df: df) -> Query:
    return lambda spark, sf_dir: fn(stored_models(spark, sf_dir)[name])


def _report(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return _stored("fct_case_lifecycle", fn)


def _model(name: str) -> Query:
    return lambda spark, sf_dir: models(spark, sf_dir)[name]


def _fact(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(models(spark, sf_dir)["fct_case_lifecycle"])


def _q_caseload(spark, sf_dir):
    return models(spark, sf_dir)["mart_advocate_caseload"]


def _stale_rows(spark, sf_dir):
    """Every stale row of the fact, from the files that hold some."""
    return stored_models(spark, sf_dir).clustered("fct_case_lifecycle").equal("stale_case_flag", True)


def _q_open_by_urgency(spark, sf_dir):
    return reports.open_by_urgency(spark, stored_models(spark, sf_dir)["fct_case_lifecycle"])


def _q_advocate_comparison(spark, sf_dir):
    m = stored_models(spark, sf_dir)
    return reports.advocate_comparison(m["fct_case_lifecycle"], m["stg_advocates"])


def _q_first_response_min(spark, sf_dir):
    return first_response_min(models(spark, sf_dir)["stg_case_events"])


def _q_interaction_stats(spark, sf_dir):
    return interaction_stats(models(spark, sf_dir)["stg_interactions"])


def core_queries() -> dict[str, Query]:
    return {
        # staging (M1–M6)
        "stg_patients": _model("stg_patients"),
        "stg_advocates": _model("stg_advocates"),
        "stg_cases": _model("stg_cases"),
        "stg_interactions": _model("stg_interactions"),
        "stg_case_events": _model("stg_case_events"),
        "stg_feedback": _model("stg_feedback"),
        # intermediate (A1, A2, M7) and fact (M8)
        "first_response_min": _q_first_response_min,
        "interaction_stats": _q_interaction_stats,
        "case_timings": _model("int_case_timings"),
        "case_lifecycle": _model("fct_case_lifecycle"),
        # marts (M9–M11)
        "ops_kpis": _model("mart_ops_kpis"),
        "advocate_caseload": _q_caseload,
        "bottleneck_missing_docs": _fact(lambda f: marts.bottleneck_branch(f, marts.MISSING_DOCS)),
        "bottleneck_handoffs": _fact(lambda f: marts.bottleneck_branch(f, marts.HANDOFFS)),
        "bottleneck_case_type": _fact(lambda f: marts.bottleneck_branch(f, marts.CASE_TYPE)),
        "bottlenecks": _model("mart_bottlenecks"),
        # report datasets (D1–D15), from the stored fact and marts
        "exec_headline": _report(reports.exec_headline),
        "metric_text": _report(lambda f: reports.metric_text(reports.exec_headline(f))),
        "backlog_by_case_type": _stored("mart_ops_kpis", reports.backlog_by_case_type),
        "kpi_table": _stored("mart_ops_kpis"),
        "bottleneck_table": _stored("mart_bottlenecks"),
        "caseload_table": _stored("mart_advocate_caseload"),
        "open_by_urgency": _q_open_by_urgency,
        "stale_cases": lambda spark, sf_dir: reports.stale_cases(_stale_rows(spark, sf_dir)),
        "stale_case_rows": _stale_rows,
        "over_capacity": _stored("mart_advocate_caseload", reports.over_capacity),
        "escalation_distribution": _report(reports.escalation_distribution),
        "interaction_load": _report(reports.interaction_load),
        "missing_docs_vs_resolution": _report(reports.missing_docs_vs_resolution),
        "handoffs_vs_csat": _report(reports.handoffs_vs_csat),
        "escalation_vs_sla": _report(reports.escalation_vs_sla),
        "case_type_delay": _report(reports.case_type_delay),
        "advocate_comparison": _q_advocate_comparison,
    }


_FACT_COLS = (
    "case_id, patient_id, advocate_id, case_type, urgency, status, created_at, assigned_at, "
    "first_response_at, resolved_at, escalation_flag, reopen_flag, handoff_count, complexity, "
    "missing_docs, hours_to_first_response, days_to_resolution, interaction_count, "
    "last_interaction_at, avg_interaction_duration_minutes, csat_score, nps_bucket, "
    "sla_breach_flag, stale_case_flag"
)


def core_oracle() -> dict[str, str]:
    q = oracle.q
    return {
        "stg_patients": q("SELECT * FROM stg_patients"),
        "stg_advocates": q("SELECT * FROM stg_advocates"),
        "stg_cases": q("SELECT * FROM stg_cases"),
        "stg_interactions": q("SELECT * FROM stg_interactions"),
        "stg_case_events": q("SELECT * FROM stg_case_events"),
        "stg_feedback": q("SELECT * FROM stg_feedback"),
        "first_response_min": q("SELECT * FROM first_response_min"),
        "interaction_stats": q("SELECT * FROM interaction_stats"),
        "case_timings": q("SELECT * FROM case_timings"),
        "case_lifecycle": q(f"SELECT {_FACT_COLS} FROM case_lifecycle"),
        "ops_kpis": q("SELECT * FROM ops_kpis"),
        "advocate_caseload": q("SELECT * FROM advocate_caseload"),
        "bottleneck_missing_docs": q("SELECT * FROM bottleneck_missing_docs"),
        "bottleneck_handoffs": q("SELECT * FROM bottleneck_handoffs"),
        "bottleneck_case_type": q("SELECT * FROM bottleneck_case_type"),
        "bottlenecks": q("SELECT * FROM bottlenecks"),
        "exec_headline": q("SELECT * FROM exec_headline"),
        "metric_text": q(
            "SELECT CAST(active_cases AS VARCHAR) AS active_cases_text, "
            "COALESCE(printf('%.1f', avg_days_to_resolution), '—') AS avg_days_text, "
            "COALESCE(printf('%.1f', sla_breach_rate_pct), '—') AS sla_breach_rate_text, "
            "COALESCE(printf('%.2f', avg_csat), '—') AS avg_csat_text, "
            "CAST(stale_cases AS VARCHAR) AS stale_cases_text FROM exec_headline"
        ),
        "backlog_by_case_type": q("SELECT case_type, open_backlog, active_cases FROM ops_kpis"),
        "kpi_table": q("SELECT * FROM ops_kpis"),
        "bottleneck_table": q("SELECT * FROM bottlenecks"),
        "caseload_table": q("SELECT * FROM advocate_caseload"),
        "open_by_urgency": q(
            "SELECT d.urgency, COALESCE(n.open_cases, 0) AS open_cases, d.position "
            "FROM (VALUES ('high', 0), ('medium', 1), ('low', 2)) AS d(urgency, position) "
            "LEFT JOIN (SELECT urgency, COUNT(*) AS open_cases FROM case_lifecycle "
            "  WHERE status IN ('open', 'in_progress', 'pending_docs', 'escalated') "
            "  GROUP BY urgency) n ON n.urgency = d.urgency ORDER BY d.position"
        ),
        "stale_case_rows": q(f"SELECT {_FACT_COLS} FROM case_lifecycle WHERE stale_case_flag"),
        "stale_cases": q(
            "SELECT case_id, case_type, urgency, status, created_at, last_interaction_at "
            "FROM case_lifecycle WHERE stale_case_flag ORDER BY case_id LIMIT 50"
        ),
        "over_capacity": q("SELECT * FROM advocate_caseload WHERE utilization_ratio > 1.0"),
        "escalation_distribution": q(
            "SELECT case_type, COUNT(*) FILTER (WHERE escalation_flag) AS escalated_cases, "
            "COUNT(escalation_flag) AS case_count, "
            "100 * COUNT(*) FILTER (WHERE escalation_flag) / NULLIF(COUNT(escalation_flag), 0) "
            "AS escalation_rate_pct FROM case_lifecycle WHERE case_type IS NOT NULL "
            "GROUP BY case_type ORDER BY case_type"
        ),
        "interaction_load": q(
            "SELECT case_type, AVG(interaction_count) AS avg_interactions, COUNT(case_id) AS cases "
            "FROM case_lifecycle WHERE case_type IS NOT NULL GROUP BY case_type ORDER BY case_type"
        ),
        "missing_docs_vs_resolution": q(
            "SELECT missing_docs, AVG(days_to_resolution) AS avg_days_to_resolution, "
            "COUNT(days_to_resolution) AS case_count FROM case_lifecycle "
            "WHERE resolved_at IS NOT NULL AND missing_docs IS NOT NULL "
            "GROUP BY missing_docs ORDER BY missing_docs"
        ),
        "handoffs_vs_csat": q(
            "SELECT handoff_count, AVG(csat_score) AS avg_csat, COUNT(case_id) AS case_count "
            "FROM case_lifecycle WHERE csat_score IS NOT NULL AND handoff_count IS NOT NULL "
            "GROUP BY handoff_count ORDER BY handoff_count"
        ),
        "escalation_vs_sla": q(
            "SELECT escalation_flag, AVG(CAST(sla_breach_flag AS INTEGER)) AS sla_breach_rate, "
            "COUNT(case_id) AS case_count FROM case_lifecycle WHERE escalation_flag IS NOT NULL "
            "GROUP BY escalation_flag ORDER BY escalation_flag"
        ),
        "case_type_delay": q(
            "SELECT case_type, AVG(days_to_resolution) AS avg_days_to_resolution "
            "FROM case_lifecycle WHERE days_to_resolution IS NOT NULL AND case_type IS NOT NULL "
            "GROUP BY case_type ORDER BY case_type"
        ),
        "advocate_comparison": q(
            "SELECT id AS advocate_id, any_value(name) AS name, any_value(team) AS team, "
            "CAST(sum(days_to_resolution) AS DOUBLE) / count(days_to_resolution) AS avg_days "
            "FROM stg_advocates JOIN case_lifecycle ON advocate_id = id GROUP BY id "
            "HAVING count(days_to_resolution) > 0"
        ),
    }


# ---------------------------------------------------------------------------
# JSON, arrays, derived columns, event log, touch filters (E8–E12, E24–E34,
# F5, F11, F12, M12, W1)
# ---------------------------------------------------------------------------

def _stg_cases(spark, sf_dir):
    return models(spark, sf_dir)["stg_cases"]


def _q_json_fields(spark, sf_dir):
    ev = bindings.read_table(spark, sf_dir, "events")
    k_text = json_field_text_sql("props", "k")
    return ev.selectExpr(
        "event_id",
        f"{k_text} AS k_text",
        f"coalesce({text_to_int_sql(k_text)}, 0) AS k",
        f"coalesce({json_field_text_sql('props', 'label')}, 'none') AS label",
    )


def _q_json_arrays_as_text(spark, sf_dir):
    return bindings.cases(spark, sf_dir).selectExpr(
        "id",
        f"{json_field_text_sql('metadata_json', 'barriers')} AS barriers_text",
        f"{json_field_text_sql('metadata_json', 'support_flags')} AS support_flags_text",
        f"{json_field_text_sql('metadata_json', 'submitted_documents')} AS submitted_documents_text",
    )


def _q_json_build_parse(spark, sf_dir):
    # The array fields are JSON text already: embed them verbatim as VARIANT
    # values (a text that is not JSON becomes NULL and its key is left out).
    doc = derive.metadata_document_sql(
        "intake_source", "try_parse_json(barriers_json)", "handoff_count", "complexity",
        "try_parse_json(submitted_documents_json)", "try_parse_json(support_flags_json)",
        "missing_docs",
    )
    with_doc = _stg_cases(spark, sf_dir).selectExpr("id AS case_id", f"{doc} AS metadata_doc")
    parsed = derive.parse_document(with_doc, "metadata_doc", ["case_id", "metadata_doc"])
    return parsed.selectExpr(
        "case_id", "metadata_doc",
        "handoff_count AS rt_handoff_count",
        "complexity AS rt_complexity",
        "missing_docs AS rt_missing_docs",
        "intake_source AS rt_intake_source",
        "barriers_json AS rt_barriers_json",
    )


def _q_array_clean_barriers(spark, sf_dir):
    cleaned = derive.clean_barriers_sql(text_array_sql("barriers_json"))
    return _stg_cases(spark, sf_dir).selectExpr(
        "id AS case_id", "barriers_json", f"to_json({cleaned}) AS clean_barriers_json")


def _q_array_support_flags(spark, sf_dir):
    flags = derive.support_flags_sql(text_array_sql("barriers_json"))
    return _stg_cases(spark, sf_dir).selectExpr("id AS case_id", f"to_json({flags}) AS support_flags_json")


def _q_nps_bucket(spark, sf_dir):
    fb = models(spark, sf_dir)["stg_feedback"]
    return fb.selectExpr("id", "case_id", "csat_score", f"{derive.nps_bucket_sql('csat_score')} AS nps")


def _q_clamp_scores(spark, sf_dir):
    p = models(spark, sf_dir)["stg_patients"]
    return p.selectExpr("id", "risk_score",
                        f"{derive.clamp_sql('risk_score', 0.0, 1.0)} AS risk_score_clamped")


def _q_derive_status(spark, sf_dir):
    return _stg_cases(spark, sf_dir).select(
        F.col("id").alias("case_id"), "status",
        derive.derive_status("status", "resolved_at", "reopen_flag").alias("derived_status"),
    )


def _q_expected_days(spark, sf_dir):
    return _stg_cases(spark, sf_dir).select(
        F.col("id").alias("case_id"), "case_type", "handoff_count",
        derive.expected_days("case_type", "handoff_count").alias("expected_days"),
    )


def _q_expected_csat(spark, sf_dir):
    csat = derive.expected_csat_sql("escalation_flag", "reopen_flag", "handoff_count")
    return _stg_cases(spark, sf_dir).selectExpr(
        "id AS case_id", f"{csat} AS expected_csat", f"{derive.nps_bucket_sql(csat)} AS expected_nps")


def _q_cap_at_as_of(spark, sf_dir):
    return _stg_cases(spark, sf_dir).select(
        F.col("id").alias("case_id"), "resolved_at",
        derive.cap_at("resolved_at", bindings.as_of_sql()).alias("resolved_at_capped"),
    )


def _q_feedback_eligible(spark, sf_dir):
    return eventlog.feedback_eligible(bindings.cases(spark, sf_dir))


def _q_touches(spark, sf_dir):
    m = models(spark, sf_dir)
    return eventlog.touches_before_resolution(m["stg_interactions"], m["stg_cases"])


def _q_reopen_rate(spark, sf_dir):
    return marts.reopen_rate(models(spark, sf_dir)["fct_case_lifecycle"])


def _q_event_log_unpivot(spark, sf_dir):
    return eventlog.event_log(_stg_cases(spark, sf_dir)).select("case_id", "event_type", "occurred_at")


def _q_event_log_ids(spark, sf_dir):
    return eventlog.event_log(_stg_cases(spark, sf_dir))


def _q_feedback_duplicates(spark, sf_dir):
    return feedback_duplicates(models(spark, sf_dir)["stg_feedback"])


def _q_metadata_rejects(spark, sf_dir):
    return metadata_rejects(bindings.cases(spark, sf_dir))


def _q_metadata_reject_rows(spark, sf_dir):
    return metadata_reject_rows(bindings.cases(spark, sf_dir))


def derived_queries() -> dict[str, Query]:
    return {
        "metadata_reject_rows": _q_metadata_reject_rows,
        "feedback_duplicates": _q_feedback_duplicates,
        "metadata_rejects": _q_metadata_rejects,
        "json_fields": _q_json_fields,
        "json_arrays_as_text": _q_json_arrays_as_text,
        "json_build_parse": _q_json_build_parse,
        "array_clean_barriers": _q_array_clean_barriers,
        "array_support_flags": _q_array_support_flags,
        "nps_bucket": _q_nps_bucket,
        "clamp_scores": _q_clamp_scores,
        "derive_status": _q_derive_status,
        "expected_days": _q_expected_days,
        "expected_csat": _q_expected_csat,
        "cap_at_as_of": _q_cap_at_as_of,
        "closed_case_feedback_eligible": _q_feedback_eligible,
        "touches_before_resolution": _q_touches,
        "reopen_rate": _q_reopen_rate,
        "event_log_unpivot": _q_event_log_unpivot,
        "event_log_ids": _q_event_log_ids,
    }


_EVENT_LOG = f"""
SELECT case_id, event_type, occurred_at,
       row_number() OVER (PARTITION BY case_id ORDER BY slot) AS seq
FROM (
    SELECT case_id, slot, event_type, occurred_at FROM (
        SELECT id AS case_id, created_at AS t0, assigned_at AS t1,
               COALESCE(first_response_at, assigned_at + INTERVAL 12 HOUR) AS t2,
               CASE WHEN missing_docs THEN COALESCE(first_response_at, assigned_at + INTERVAL 12 HOUR)
                                           + INTERVAL 2 HOUR END AS t3,
               CASE WHEN missing_docs AND resolved_at IS NOT NULL THEN resolved_at - INTERVAL 1 DAY END AS t4,
               resolved_at AS t5
        FROM stg_cases
    ) s,
    LATERAL (VALUES (0, 'opened', t0), (1, 'assigned', t1), (2, 'first_response', t2),
                    (3, 'docs_requested', t3), (4, 'docs_received', t4), (5, 'resolved', t5))
        AS v(slot, event_type, occurred_at)
    WHERE occurred_at IS NOT NULL
)"""


def derived_oracle() -> dict[str, str]:
    q = oracle.q
    arr = "CAST(json(barriers_json) AS VARCHAR[])"
    raw_csat = (
        "4.0E0 - CASE WHEN escalation_flag THEN 0.6E0 ELSE 0E0 END "
        "- CASE WHEN reopen_flag THEN 0.8E0 ELSE 0E0 END - handoff_count * 0.15E0"
    )
    csat = f"CASE WHEN ({raw_csat}) IS NOT NULL THEN greatest(1E0, least(5E0, {raw_csat})) END"
    return {
        "feedback_duplicates": q(
            "SELECT case_id, COUNT(*) AS feedback_rows FROM stg_feedback "
            "GROUP BY case_id HAVING COUNT(*) > 1"
        ),
        "metadata_rejects": q(
            "SELECT count(metadata_json) AS documents, "
            "count(*) FILTER (metadata_json IS NOT NULL AND (NOT json_valid(metadata_json) OR json_type("
            "if(json_valid(metadata_json), metadata_json, 'null')) <> 'OBJECT')) AS rejected, "
            "count(*) FILTER (field[1] IS NOT NULL AND TRY_CAST(TRY_CAST(trim(field[1]) AS DOUBLE) AS INTEGER) "
            "IS NULL) AS bad_handoff_count, "
            "count(*) FILTER (field[3] NOT IN ('true', 'false')) AS bad_missing_docs FROM case_fields"
        ),
        "metadata_reject_rows": q(
            "SELECT id AS case_id, name AS field, value FROM case_fields, unnest(["
            "{'name': 'document', 'value': metadata_json, 'bad': metadata_json IS NOT NULL AND (NOT json_valid("
            "metadata_json) OR json_type(if(json_valid(metadata_json), metadata_json, 'null')) <> 'OBJECT')}, "
            "{'name': 'handoff_count', 'value': field[1], 'bad': field[1] IS NOT NULL AND "
            "TRY_CAST(TRY_CAST(trim(field[1]) AS DOUBLE) AS INTEGER) IS NULL}, "
            "{'name': 'missing_docs', 'value': field[3], 'bad': field[3] NOT IN ('true', 'false')}]) AS t(r), "
            "LATERAL (SELECT r.name AS name, r.value AS value, r.bad AS bad) WHERE bad"
        ),
        "json_fields": q(
            "SELECT event_id, json_extract_string(props, '$.k') AS k_text, "
            "COALESCE(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k, "
            "COALESCE(json_extract_string(props, '$.label'), 'none') AS label FROM events"
        ),
        "json_arrays_as_text": q(
            "SELECT id, field[5] AS barriers_text, field[6] AS support_flags_text, "
            "field[7] AS submitted_documents_text FROM case_fields"
        ),
        "json_build_parse": q(
            "SELECT case_id, metadata_doc, "
            "COALESCE(CAST(json_extract_string(metadata_doc, '$.handoff_count') AS INTEGER), 0) AS rt_handoff_count, "
            "TRIM(COALESCE(json_extract_string(metadata_doc, '$.complexity'), 'medium')) AS rt_complexity, "
            "COALESCE(json_extract_string(metadata_doc, '$.missing_docs') = 'true', false) AS rt_missing_docs, "
            "TRIM(COALESCE(json_extract_string(metadata_doc, '$.intake_source'), '')) AS rt_intake_source, "
            "COALESCE(json_extract_string(metadata_doc, '$.barriers'), '[]') AS rt_barriers_json "
            "FROM (SELECT id AS case_id, CAST(json_object("
            "'intake_source', intake_source, 'barriers', json(barriers_json), "
            "'handoff_count', handoff_count, 'complexity', complexity, "
            "'submitted_documents', json(submitted_documents_json), "
            "'support_flags', json(support_flags_json), 'missing_docs', missing_docs) AS VARCHAR) "
            "AS metadata_doc FROM stg_cases)"
        ),
        "array_clean_barriers": q(
            f"SELECT id AS case_id, barriers_json, CAST(to_json(CASE WHEN len({arr}) > 1 "
            f"THEN list_filter({arr}, lambda x: x IS DISTINCT FROM 'none') ELSE {arr} END) AS VARCHAR) "
            "AS clean_barriers_json FROM stg_cases"
        ),
        "array_support_flags": q(
            f"SELECT id AS case_id, CAST(to_json(list_filter({arr}, "
            "lambda x: x IN ('language', 'transportation'))) AS VARCHAR) AS support_flags_json FROM stg_cases"
        ),
        "nps_bucket": q(
            "SELECT id, case_id, csat_score, CASE WHEN csat_score >= 4.5 THEN 'promoter' "
            "WHEN csat_score >= 3.5 THEN 'passive' ELSE 'detractor' END AS nps FROM stg_feedback"
        ),
        "clamp_scores": q(
            "SELECT id, risk_score, CASE WHEN risk_score IS NOT NULL "
            "THEN greatest(0E0, least(1E0, risk_score)) END AS risk_score_clamped FROM stg_patients"
        ),
        "derive_status": q(
            "SELECT id AS case_id, status, CASE WHEN resolved_at IS NOT NULL THEN "
            "CASE WHEN reopen_flag THEN 'reopened' ELSE 'resolved' END ELSE status END "
            "AS derived_status FROM stg_cases"
        ),
        "expected_days": q(
            "SELECT case_id, case_type, handoff_count, CASE WHEN raw IS NOT NULL "
            "THEN greatest(1E0, raw) END AS expected_days FROM ("
            "SELECT id AS case_id, case_type, handoff_count, "
            "CASE case_type WHEN 'prior_authorization' THEN 8E0 WHEN 'claim_denial' THEN 9E0 "
            "WHEN 'billing_dispute' THEN 4E0 WHEN 'provider_search' THEN 5E0 "
            "WHEN 'care_coordination' THEN 6E0 END + handoff_count * 0.5E0 AS raw FROM stg_cases)"
        ),
        "expected_csat": q(
            f"SELECT id AS case_id, {csat} AS expected_csat, "
            f"CASE WHEN {csat} >= 4.5 THEN 'promoter' WHEN {csat} >= 3.5 THEN 'passive' "
            "ELSE 'detractor' END AS expected_nps FROM stg_cases"
        ),
        "cap_at_as_of": q(
            "SELECT id AS case_id, resolved_at, CASE WHEN resolved_at IS NOT NULL "
            f"THEN least(resolved_at, {oracle.AS_OF_TS}) END AS resolved_at_capped FROM stg_cases"
        ),
        "closed_case_feedback_eligible": q(
            "SELECT id, status, resolved_at FROM raw_cases WHERE status IN ('resolved', 'reopened') "
            "AND resolved_at IS NOT NULL AND TRIM(CAST(resolved_at AS VARCHAR)) <> ''"
        ),
        "touches_before_resolution": q(
            "SELECT i.case_id, COUNT(*) AS touches_before_resolution FROM stg_interactions i "
            "JOIN stg_cases c ON c.id = i.case_id "
            "WHERE c.resolved_at IS NULL OR i.created_at < c.resolved_at GROUP BY i.case_id"
        ),
        "reopen_rate": q(
            "SELECT case_type, COUNT(*) FILTER (WHERE status IN ('resolved', 'reopened')) AS closed_cases, "
            "COUNT(*) FILTER (WHERE reopen_flag) AS reopened_cases, "
            "ROUND(100.0 * COUNT(*) FILTER (WHERE reopen_flag) "
            "/ NULLIF(COUNT(*) FILTER (WHERE status IN ('resolved', 'reopened')), 0), 2) AS reopen_rate_pct "
            "FROM case_lifecycle GROUP BY case_type"
        ),
        "event_log_unpivot": q(f"SELECT case_id, event_type, occurred_at FROM ({_EVENT_LOG})"),
        "event_log_ids": q(f"SELECT case_id, seq, event_type, occurred_at FROM ({_EVENT_LOG})"),
    }


# ---------------------------------------------------------------------------
# Sources, sinks, catalog and the layered run
# ---------------------------------------------------------------------------

# The six raw tables as one set of rows: slot of the common row -> column.
RAW_SLOTS = {
    "patients": "id, s1 insurance_type, s2 preferred_channel, s3 state, d1 risk_score, t1 created_at",
    "advocates": "id, s1 name, s2 specialty, s3 team, n1 capacity, dt1 hire_date",
    "cases": "id, k1 patient_id, k2 advocate_id, s1 case_type, s2 urgency, s3 status, t1 created_at, "
             "t2 assigned_at, t3 first_response_at, t4 resolved_at, n1 escalation_flag, n2 reopen_flag, "
             "s4 metadata_json",
    "interactions": "id, k1 case_id, s1 type, t1 created_at, d1 duration_minutes, k2 advocate_id",
    "case_events": "id, k1 case_id, s1 event_type, t1 occurred_at",
    "patient_feedback": "id, k1 case_id, d1 csat_score, s1 nps_bucket, s2 feedback_text, t1 submitted_at",
}
SLOT_TYPES = {**{c: "BIGINT" for c in ("id", "k1", "k2")}, "d1": "DOUBLE", "n1": "INT", "n2": "INT",
              **{c: "{text}" for c in ("s1", "s2", "s3", "s4")},
              **{c: "{ts}" for c in ("t1", "t2", "t3", "t4")}, "dt1": "DATE"}


def _slots(table: str, text: str, ts: str) -> str:
    given = dict(p.split() if " " in p else (p, p) for p in RAW_SLOTS[table].split(", "))
    return f"'{table}' AS raw_table, " + ", ".join(
        f"CAST({given.get(c, 'NULL')} AS {t.format(text=text, ts=ts)}) AS {c}" for c, t in SLOT_TYPES.items())


def _q_csv_round_trip(spark, sf_dir):
    """Write the six raw inputs as CSV and read every row of them back."""
    folder = scratch_path(spark, "raw-csv")
    files.write_raw_tables(bindings.raw_tables(spark, sf_dir), folder)
    out = None
    for table, df in files.read_raw_tables(spark, folder, "csv").items():
        part = df.selectExpr(*_slots(table, "STRING", "TIMESTAMP_NTZ").split(", "))
        out = part if out is None else out.unionByName(part)
    return out


# A year of daily clocks.
CLOCK_START, CLOCKS = "1998-01-01 12:30:00", 365
# The clock the maintained marts' state was built with, before the changes.
EARLIER = "1998-03-01 09:00:00"


def _q_flags_over_year(spark, sf_dir):
    return clocks.flag_counts(models(spark, sf_dir)["fct_case_lifecycle"], CLOCK_START, CLOCKS)


def _maintained(mart: maintain.Mart) -> Query:
    """A mart kept by the fact's changes between two clocks, over stored facts."""

    def run(spark, sf_dir):
        raw = bindings.raw_tables(spark, sf_dir)
        old, new = (materialize(spark, build_all(spark, raw, as_of=clock)["fct_case_lifecycle"], "fact")
                    for clock in (EARLIER, bindings.AS_OF))
        state = materialize(spark, mart.state(old), "state")
        return mart.finish(maintain.maintain(mart, state, maintain.fact_changes(old, new)))

    return run


def _q_csv_types(spark, sf_dir):
    """Write the six raw inputs as CSV and find the type of every column."""
    folder = scratch_path(spark, "csv-types")
    files.write_raw_tables(bindings.raw_tables(spark, sf_dir), folder)
    found = None
    for table, filename in files.RAW_FILES.items():
        part = sniff.sniff(spark, f"{folder}/{filename}").selectExpr(
            f"'{table}' AS raw_table", "position", "column_name", "type", "value_count")
        found = part if found is None else found.union(part)
    return found


def _q_csv_quoted_lines(spark, sf_dir):
    """Feedback texts with line breaks through CSV, every row read by many tasks."""
    folder = scratch_path(spark, "csv-lines")
    given = bindings.raw_tables(spark, sf_dir)["patient_feedback"].withColumn("feedback_text", F.expr(LINED_TEXT))
    files.write_csv(given, folder)
    return files.read_raw_csv(spark, folder, "patient_feedback", multi_line=True)


# Every feedback text spread over lines, with quotes and a delimiter.
LINED_TEXT = "concat('say \"', coalesce(feedback_text, '-'), '\",\nfor ', coalesce(nps_bucket, '-'), '\n\nend')"


def _q_table_round_trip(spark, sf_dir):
    """The KPI mart through tables of a fresh catalog prefix, bucketed staging."""
    location, prefix = scratch_path(spark, "tables"), f"q{uuid.uuid4().hex[:12]}"
    buckets = bucket_count(spark, bindings.raw_tables(spark, sf_dir))
    persist_layers(spark, models(spark, sf_dir), prefix, location, buckets)
    mart = spark.table(f"{prefix}_marts.mart_ops_kpis")
    kept = spark.read.schema(mart.schema).parquet(layer_path(location, prefix, "mart_ops_kpis"))
    for layer in LAYERS:  # external tables: their rows stay
        spark.sql(f"DROP DATABASE {prefix}_{layer} CASCADE")
    return kept


def _q_mart_ready(spark, sf_dir):
    """A mart that was stored is ready; one that never was is not."""
    location = scratch_path(spark, "ready")
    persist_layers(spark, models(spark, sf_dir), "q", location, names=["mart_ops_kpis"], register=False)
    return files.readiness(spark, {
        "mart_ops_kpis": layer_path(location, "q", "mart_ops_kpis"),
        "mart_never_stored": f"{location}/q_marts.db/mart_never_stored"})


def _q_pipeline_all(spark, sf_dir):
    """The layered run: all 11 models stored, with the rows each one wrote."""
    done = versions.refresh(spark, bindings.raw_tables(spark, sf_dir), scratch_path(spark, "layers"), bindings.AS_OF)
    return spark.createDataFrame([(n, m["rows"]) for n, m in done["models"].items()],
                                 "model string, row_count bigint")


def source_queries() -> dict[str, Query]:
    return {
        "stream_first_response": incremental.stream_first_response,
        "stream_interaction_stats": incremental.stream_interaction_stats,
        "stream_case_timings": incremental.stream_case_timings,
        "csv_round_trip": _q_csv_round_trip,
        "csv_types": _q_csv_types,
        "flags_over_year": _q_flags_over_year,
        "maintained_ops_kpis": _maintained(maintain.OPS_KPIS),
        "maintained_bottlenecks": _maintained(maintain.BOTTLENECKS),
        "csv_quoted_lines": _q_csv_quoted_lines,
        "table_round_trip": _q_table_round_trip,
        "mart_ready": _q_mart_ready,
        "pipeline_all": _q_pipeline_all,
    }


_MODEL_CTES = {
    "stg_patients": "stg_patients", "stg_advocates": "stg_advocates", "stg_cases": "stg_cases",
    "stg_interactions": "stg_interactions", "stg_case_events": "stg_case_events",
    "stg_feedback": "stg_feedback", "int_case_timings": "case_timings",
    "fct_case_lifecycle": "case_lifecycle", "mart_ops_kpis": "ops_kpis",
    "mart_advocate_caseload": "advocate_caseload", "mart_bottlenecks": "bottlenecks",
}


def source_oracle() -> dict[str, str]:
    q = oracle.q
    counts = " UNION ALL ".join(
        f"SELECT '{model}' AS model, COUNT(*) AS row_count FROM {cte}"
        for model, cte in _MODEL_CTES.items()
    )
    return {
        "stream_first_response": q("SELECT * FROM first_response_min"),
        "stream_interaction_stats": q("SELECT * FROM interaction_stats"),
        "stream_case_timings": q("SELECT * FROM case_timings"),
        # An empty text is an empty field, which reads back as NULL.
        "csv_round_trip": q("SELECT * REPLACE (nullif(s2, '') AS s2) FROM (" + " UNION ALL ".join(
            f"SELECT {_slots(t, 'VARCHAR', 'TIMESTAMP')} FROM raw_{t}" for t in RAW_SLOTS) + ")"),
        "mart_ready": q("SELECT 'mart_ops_kpis' AS mart, (SELECT COUNT(*) FROM ops_kpis) >= 0 AS ready "
                        "UNION ALL SELECT 'mart_never_stored', false"),
        "csv_types": q(oracle.csv_types_sql()),
        "flags_over_year": q(oracle.flags_sql(CLOCK_START, CLOCKS)),
        "maintained_ops_kpis": q("SELECT * FROM ops_kpis"),
        "maintained_bottlenecks": q("SELECT * FROM bottlenecks"),
        "csv_quoted_lines": q(
            "SELECT * REPLACE ('say \"' || coalesce(feedback_text, '-') || '\",' || chr(10) || 'for ' || "
            "coalesce(nps_bucket, '-') || chr(10) || chr(10) || 'end' AS feedback_text, "
            "strftime(submitted_at, '%Y-%m-%dT%H:%M:%S.%f') AS submitted_at) FROM raw_patient_feedback"),
        "table_round_trip": q("SELECT * FROM ops_kpis"),
        "pipeline_all": q(counts),
    }


def queries() -> dict[str, Query]:
    return {**core_queries(), **derived_queries(), **source_queries()}


def oracle_sql() -> dict[str, str]:
    return {**core_oracle(), **derived_oracle(), **source_oracle()}
