"""Staging models M1–M6: typed, trimmed copies of the raw inputs.

Each model is a projection (``stg_cases`` adds one ``json_tuple`` per row),
so Catalyst folds it into the scan stage and prunes the scan, and the JSON
fields, to the columns a consumer uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.functions.exprs import blank_to_null_ts_sql, int_flag_sql, text_to_int_sql
from casekit.functions.json import json_fields_sql, metadata_columns_sql


def _dtype(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def stg_patients(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id",
        "trim(insurance_type) AS insurance_type",
        "trim(preferred_channel) AS preferred_channel",
        "trim(state) AS state",
        "CAST(risk_score AS DOUBLE) AS risk_score",
        "CAST(created_at AS TIMESTAMP_NTZ) AS created_at",
    )


def stg_advocates(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id",
        "trim(name) AS name",
        "trim(specialty) AS specialty",
        "trim(team) AS team",
        "CAST(capacity AS INT) AS capacity",
        "CAST(hire_date AS DATE) AS hire_date",
    )


def stg_cases(raw: DataFrame) -> DataFrame:
    """Typed cases plus the seven metadata fields, parsed once per row."""
    meta = metadata_columns_sql("_m_")
    parsed = raw.selectExpr("*", json_fields_sql("metadata_json", "_m_"))
    return parsed.selectExpr(
        "id",
        "patient_id",
        "advocate_id",
        "trim(case_type) AS case_type",
        "trim(urgency) AS urgency",
        "trim(status) AS status",
        "CAST(created_at AS TIMESTAMP_NTZ) AS created_at",
        "CAST(assigned_at AS TIMESTAMP_NTZ) AS assigned_at",
        f"{blank_to_null_ts_sql('first_response_at', _dtype(raw, 'first_response_at'))} AS first_response_at",
        f"{blank_to_null_ts_sql('resolved_at', _dtype(raw, 'resolved_at'))} AS resolved_at",
        f"{int_flag_sql('escalation_flag')} AS escalation_flag",
        f"{int_flag_sql('reopen_flag')} AS reopen_flag",
        "metadata_json",
        *[f"{sql} AS {name}" for name, sql in meta.items()],
    )


_BAD_DOCUMENT = "metadata_json IS NOT NULL AND json_object_keys(metadata_json) IS NULL"
_BAD_HANDOFF = f"_m_handoff_count IS NOT NULL AND {text_to_int_sql('_m_handoff_count')} IS NULL"
_BAD_MISSING_DOCS = "_m_missing_docs NOT IN ('true', 'false')"


def metadata_rejects(raw_cases: DataFrame) -> DataFrame:
    """Documents that are no JSON object and fields that are not of
    their type.

    The reference fails the whole load on such a cell; here the row takes the
    defaults and these counts report how many did.
    """
    parsed = raw_cases.selectExpr("metadata_json", json_fields_sql("metadata_json", "_m_"))
    return parsed.agg(
        F.expr("count(metadata_json) AS documents"),
        F.expr(f"count_if({_BAD_DOCUMENT}) AS rejected"),
        F.expr(f"count_if({_BAD_HANDOFF}) AS bad_handoff_count"),
        F.expr(f"count_if({_BAD_MISSING_DOCS}) AS bad_missing_docs"),
    )


def metadata_reject_rows(raw_cases: DataFrame) -> DataFrame:
    """The rejects themselves: (case_id, field, value)."""
    parsed = raw_cases.selectExpr("id", "metadata_json", json_fields_sql("metadata_json", "_m_"))
    return parsed.selectExpr(
        "id AS case_id",
        "inline(array("
        f"named_struct('field', 'document', 'value', metadata_json, 'bad', {_BAD_DOCUMENT}), "
        f"named_struct('field', 'handoff_count', 'value', _m_handoff_count, 'bad', {_BAD_HANDOFF}), "
        f"named_struct('field', 'missing_docs', 'value', _m_missing_docs, 'bad', {_BAD_MISSING_DOCS})))",
    ).where("bad").drop("bad")


def stg_interactions(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id",
        "case_id",
        "trim(type) AS type",
        "CAST(created_at AS TIMESTAMP_NTZ) AS created_at",
        "CAST(duration_minutes AS DOUBLE) AS duration_minutes",
        "advocate_id",
    )


def stg_case_events(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id",
        "case_id",
        "trim(event_type) AS event_type",
        "CAST(occurred_at AS TIMESTAMP_NTZ) AS occurred_at",
    )


def stg_feedback(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id",
        "case_id",
        "CAST(csat_score AS DOUBLE) AS csat_score",
        "trim(nps_bucket) AS nps_bucket",
        "trim(feedback_text) AS feedback_text",
        "CAST(submitted_at AS TIMESTAMP_NTZ) AS submitted_at",
    )


# Staging model name -> (builder, raw table it reads).
STAGING = {
    "stg_patients": (stg_patients, "patients"),
    "stg_advocates": (stg_advocates, "advocates"),
    "stg_cases": (stg_cases, "cases"),
    "stg_interactions": (stg_interactions, "interactions"),
    "stg_case_events": (stg_case_events, "case_events"),
    "stg_feedback": (stg_feedback, "patient_feedback"),
}
