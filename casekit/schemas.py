"""Explicit schemas for the six raw input tables.

Types follow what the reference's CSV loader sniffs (ids BIGINT, zone-less
TIMESTAMP, ...).  Never infer at scale: inference is a full extra pass over
the input and gives INT / zoned timestamps instead.

The two timestamps that the reference writes as blank text when absent
(``first_response_at``, ``resolved_at``) and the JSON document are read as
strings; staging owns the blank guard and the parse.
"""

from __future__ import annotations

from pyspark.sql import types as T

PATIENTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("insurance_type", T.StringType()),
    T.StructField("preferred_channel", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("risk_score", T.DoubleType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

ADVOCATES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("specialty", T.StringType()),
    T.StructField("team", T.StringType()),
    T.StructField("capacity", T.IntegerType()),
    T.StructField("hire_date", T.DateType()),
])

CASES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("patient_id", T.LongType()),
    T.StructField("advocate_id", T.LongType()),
    T.StructField("case_type", T.StringType()),
    T.StructField("urgency", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("assigned_at", T.TimestampNTZType()),
    T.StructField("first_response_at", T.StringType()),
    T.StructField("resolved_at", T.StringType()),
    T.StructField("escalation_flag", T.IntegerType()),
    T.StructField("reopen_flag", T.IntegerType()),
    T.StructField("metadata_json", T.StringType()),
])

INTERACTIONS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("case_id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("duration_minutes", T.DoubleType()),
    T.StructField("advocate_id", T.LongType()),
])

CASE_EVENTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("case_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("occurred_at", T.TimestampNTZType()),
])

PATIENT_FEEDBACK = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("case_id", T.LongType()),
    T.StructField("csat_score", T.DoubleType()),
    T.StructField("nps_bucket", T.StringType()),
    T.StructField("feedback_text", T.StringType()),
    T.StructField("submitted_at", T.TimestampNTZType()),
])

# Raw table name -> schema; the ingest registry iterates over this.
RAW = {
    "patients": PATIENTS,
    "advocates": ADVOCATES,
    "cases": CASES,
    "interactions": INTERACTIONS,
    "case_events": CASE_EVENTS,
    "patient_feedback": PATIENT_FEEDBACK,
}
