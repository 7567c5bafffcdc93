"""DuckDB oracle SQL for every catalogued query.

The expected rows are computed from the models' rules by another method than
the engine uses, over the driver's tables bound to the six raw inputs exactly
as ``casekit.sources.bindings`` binds them.  Each query is ``WITH <shared
CTEs> <final SELECT>``; DuckDB skips CTEs a query does not reference.
"""

from __future__ import annotations

from casekit import schemas

AS_OF_TS = "TIMESTAMP '1998-06-15 12:30:00'"

# The case document's text, concatenated as the binding does.
_BARRIERS = "['language', 'transportation', 'cost', 'health_literacy', 'none']"
_DOCUMENT = f"""CASE WHEN o_orderkey % 11 = 0 THEN NULL
           WHEN o_orderkey % 97 = 0 THEN '{{"handoff_count":'
           WHEN o_orderkey % 101 = 0 THEN '[1,2]'
           ELSE '{{"handoff_count":' || CASE WHEN o_orderkey % 17 = 0 THEN '"many"'
                    WHEN o_orderkey % 19 = 0 THEN '"2"' WHEN o_orderkey % 23 = 0 THEN '99999999999'
                    ELSE CAST(o_orderkey % 5 AS VARCHAR) END
             || ',"missing_docs":' || CASE WHEN o_orderkey % 29 = 0 THEN '"maybe"'
                    WHEN o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END
             || CASE WHEN o_orderkey % 7 <> 0 THEN ',"complexity":"high"' ELSE '' END
             || ',"intake_source":"phone"'
             || ',"barriers":[' || CASE WHEN o_orderkey % 13 = 0 THEN '"none"' ELSE array_to_string(
                    list_transform(range(CAST(1 + o_orderkey % 3 AS INTEGER)),
                        lambda i: '"' || {_BARRIERS}[1 + CAST((o_orderkey // 3 + (1 + o_orderkey // 15 % 4) * i) % 5 AS INTEGER)] || '"'), ',') END
             || '],"support_flags":[' || CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '"language"'
                    WHEN 2 THEN '"transportation"' ELSE '"language","transportation"' END
             || '],"submitted_documents":[' || CASE WHEN o_orderkey % 3 = 1 THEN '"id_card"' ELSE '' END || ']}}' END"""

_RAW = """
raw_patients AS (
    SELECT c_custkey AS id,
           c_mktsegment AS insurance_type,
           CASE c_custkey % 4 WHEN 0 THEN 'phone' WHEN 1 THEN 'email'
                              WHEN 2 THEN 'chat' ELSE 'portal' END AS preferred_channel,
           'S' || CAST(c_nationkey AS VARCHAR) AS state,
           c_acctbal / 10000E0 AS risk_score,
           CAST(DATE '2000-01-01' - CAST(c_custkey % 700 AS INTEGER) AS TIMESTAMP) AS created_at
    FROM customer
),
raw_advocates AS (
    SELECT c_custkey AS id,
           ' ' || c_name AS name,
           c_mktsegment AS specialty,
           'team_' || CAST(c_nationkey % 4 AS VARCHAR) AS team,
           CAST(floor(abs(c_acctbal) / 1000E0) AS INTEGER) AS capacity,
           DATE '2000-01-01' - CAST(c_custkey % 1000 AS INTEGER) AS hire_date
    FROM customer
),
orders_clock AS (
    SELECT *,
           o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
                       + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) AS created_ts
    FROM orders
),
raw_cases_0 AS (
    SELECT o_orderkey AS id,
           o_custkey AS patient_id,
           o_custkey AS advocate_id,
           o_orderpriority AS case_type,
           CASE o_orderkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS urgency,
           CASE o_orderstatus
               WHEN 'F' THEN CASE WHEN o_orderkey % 12 = 0 THEN 'reopened' ELSE 'resolved' END
               WHEN 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'pending_docs' ELSE 'in_progress' END
               WHEN 'O' THEN CASE WHEN o_orderkey % 5 = 0 THEN 'escalated' ELSE 'open' END
           END AS status,
           created_ts AS created_at,
           created_ts + to_hours(CAST(o_orderkey % 4 + 1 AS INTEGER)) AS assigned_at,
           CASE WHEN o_orderstatus = 'F'
                THEN created_ts + to_hours(CAST(o_orderkey % 48 + 1 AS INTEGER)) + to_milliseconds(250)
           END AS first_response_at,
           CASE WHEN o_orderstatus = 'F'
                THEN o_orderdate + to_days(CAST((o_orderkey * 7) % 20 + 1 AS INTEGER))
           END AS resolved_at,
           CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS escalation_flag,
           {_DOCUMENT} AS metadata_json
    FROM orders_clock
),
raw_cases AS (
    SELECT id, patient_id, advocate_id, case_type, urgency, status, created_at, assigned_at,
           first_response_at, resolved_at, escalation_flag,
           CASE WHEN status = 'reopened' THEN 1 ELSE 0 END AS reopen_flag,
           metadata_json
    FROM raw_cases_0
),
raw_interactions AS (
    SELECT l_orderkey * 100 + l_linenumber AS id,
           l_orderkey AS case_id,
           CASE l_returnflag WHEN 'R' THEN 'call' WHEN 'A' THEN 'email' ELSE 'doc_request' END AS type,
           l_shipdate AS created_at,
           l_quantity AS duration_minutes,
           l_suppkey AS advocate_id
    FROM lineitem
),
raw_case_events AS (
    SELECT event_id AS id,
           user_id AS case_id,
           CASE event_type WHEN 'signup' THEN 'opened' WHEN 'view' THEN 'assigned'
                           WHEN 'click' THEN 'first_response' WHEN 'error' THEN 'escalated'
                           ELSE 'resolved' END AS event_type,
           ts AS occurred_at
    FROM events
),
feedback_score AS (
    SELECT doc_id, n,
           least(5E0, greatest(1E0, 1E0 + 2E0 * quality + (doc_id % 5) * 0.5E0 - toxic - n * 0.5E0)) AS csat
    FROM labels, unnest(CASE WHEN doc_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS t(n)
),
raw_patient_feedback AS (
    SELECT doc_id + n * 1000000000 AS id,
           doc_id AS case_id,
           csat AS csat_score,
           CASE WHEN csat >= 4.5 THEN 'promoter' WHEN csat >= 3.5 THEN 'passive'
                ELSE 'detractor' END AS nps_bucket,
           CASE WHEN doc_id % 2 = 0 THEN '' ELSE ' ok ' END AS feedback_text,
           CAST(DATE '1998-01-01' + CAST(doc_id % 90 AS INTEGER) AS TIMESTAMP) AS submitted_at
    FROM feedback_score
)"""

# --- expected results, by another method than the engine's --------------------
# Staging replaces columns in place; time spans are integer microseconds; both
# kinds of touches are summarised in one pass over a tagged table; means are
# sums over counts; every bottleneck analysis comes from one unnested table.


def _trimmed(table: str, *columns: str) -> str:
    cells = ", ".join(f"trim({c}) AS {c}" for c in columns)
    return f"(SELECT * REPLACE ({cells}) FROM {table})"


def _mean(x: str) -> str:
    return f"(CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0))"


def _share(part: str, whole: str) -> str:
    return f"(1E2 * {part} / nullif({whole}, 0))"


def _times(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END)"


_DAY, _HOUR = 86400000000, 3600000000
_SPAN = "(epoch_us(first_seen) - epoch_us(created_at))"
_CLOSED = "status IN ('resolved', 'reopened')"
_ACTIVE = f"(count(status) - {_times(_CLOSED)})"

_STAGING = f"""
stg_patients AS {_trimmed("raw_patients", "insurance_type", "preferred_channel", "state")},
stg_advocates AS {_trimmed("raw_advocates", "name", "specialty", "team")},
stg_interactions AS {_trimmed("raw_interactions", "type")},
stg_case_events AS {_trimmed("raw_case_events", "event_type")},
stg_feedback AS {_trimmed("raw_patient_feedback", "nps_bucket", "feedback_text")},
case_fields AS (
    SELECT *, json_extract_string(if(json_valid(metadata_json), metadata_json, NULL),
        ['$.handoff_count', '$.complexity', '$.missing_docs', '$.intake_source',
         '$.barriers', '$.support_flags', '$.submitted_documents']) AS field
    FROM raw_cases
),
stg_cases AS (
    SELECT * EXCLUDE (field) REPLACE (trim(case_type) AS case_type, trim(urgency) AS urgency,
        trim(status) AS status, escalation_flag = 1 AS escalation_flag, reopen_flag = 1 AS reopen_flag),
        ifnull(TRY_CAST(TRY_CAST(trim(field[1]) AS DOUBLE) AS INTEGER), 0) AS handoff_count,
        trim(ifnull(field[2], 'medium')) AS complexity,
        ifnull(field[3], '') = 'true' AS missing_docs,
        trim(ifnull(field[4], '')) AS intake_source,
        ifnull(field[5], '[]') AS barriers_json,
        ifnull(field[6], '[]') AS support_flags_json,
        ifnull(field[7], '[]') AS submitted_documents_json
    FROM case_fields
)"""

_TIMINGS = f"""
touch AS (
    SELECT case_id, true AS answered, occurred_at AS moment, NULL::DOUBLE AS minutes
    FROM stg_case_events WHERE event_type = 'first_response'
    UNION ALL SELECT case_id, false, created_at, duration_minutes FROM stg_interactions
),
per_case AS (
    SELECT case_id, min(CASE WHEN answered THEN moment END) AS first_at,
           {_times("NOT answered")} AS touches, max(CASE WHEN NOT answered THEN moment END) AS last_at,
           {_mean("minutes")} AS mean_minutes
    FROM touch GROUP BY case_id
),
first_response_min AS (
    SELECT case_id, first_at AS first_response_at FROM per_case WHERE first_at IS NOT NULL
),
interaction_stats AS (
    SELECT case_id, touches AS interaction_count, last_at AS last_interaction_at,
           mean_minutes AS avg_duration_minutes
    FROM per_case WHERE touches > 0
),
timed AS (
    SELECT s.* RENAME (id AS case_id, first_response_at AS first_response_at_case),
           p.first_at AS first_response_at_event, ifnull(p.first_at, s.first_response_at) AS first_seen,
           ifnull(p.touches, 0) AS interaction_count, p.last_at AS last_interaction_at,
           p.mean_minutes AS avg_interaction_duration_minutes
    FROM stg_cases s LEFT JOIN per_case p ON p.case_id = s.id
),
case_timings AS (
    SELECT case_id, patient_id, advocate_id, case_type, urgency, status, created_at, assigned_at,
           first_response_at_case, first_response_at_event, resolved_at, escalation_flag, reopen_flag,
           handoff_count, complexity, missing_docs, interaction_count, last_interaction_at,
           avg_interaction_duration_minutes,
           (({_SPAN} - {_SPAN} % {_DAY}) / {_DAY}E0 * 86400E0 + {_SPAN} % {_DAY} / 1E6) / 3600E0
               AS hours_to_first_response,
           CAST(resolved_at AS DATE) - CAST(created_at AS DATE) AS days_to_resolution
    FROM timed
)"""

_FACT = f"""
case_lifecycle AS (
    SELECT t.* EXCLUDE (first_response_at_case, first_response_at_event),
           ifnull(first_response_at_event, first_response_at_case) AS first_response_at,
           csat_score, nps_bucket,
           CAST(ifnull(resolved_at, {AS_OF_TS}) AS DATE) - CAST(created_at AS DATE) > 7 AS sla_breach_flag,
           resolved_at IS NULL AND epoch_us({AS_OF_TS}) // {_HOUR}
               - epoch_us(ifnull(last_interaction_at, created_at)) // {_HOUR} > 48 AS stale_case_flag
    FROM case_timings t LEFT JOIN stg_feedback f USING (case_id)
)"""

_MARTS = f"""
ops_kpis AS (
    SELECT case_type, count(*) AS total_cases, {_ACTIVE} AS active_cases, {_ACTIVE} AS open_backlog,
           round({_mean("hours_to_first_response")}, 2) AS avg_hours_to_first_response,
           round({_mean("days_to_resolution")}, 2) AS avg_days_to_resolution,
           round({_share(_times("escalation_flag"), "count(*)")}, 2) AS escalation_rate_pct,
           round({_share(_times("reopen_flag"), _times(_CLOSED))}, 2) AS reopen_rate_pct,
           round({_share(_times("sla_breach_flag"), "count(*)")}, 2) AS sla_breach_rate_pct,
           round({_mean("interaction_count")}, 2) AS avg_interactions_per_case,
           round({_mean("csat_score")}, 2) AS avg_csat,
           {_times("stale_case_flag")} AS stale_cases_count
    FROM case_lifecycle GROUP BY case_type
),
load AS (SELECT advocate_id, {_ACTIVE} AS active FROM case_lifecycle GROUP BY advocate_id),
advocate_caseload AS (
    SELECT id AS advocate_id, name, team, specialty, capacity, ifnull(active, 0) AS active_cases,
           round(1E0 * ifnull(active, 0) / nullif(capacity, 0), 2) AS utilization_ratio
    FROM stg_advocates LEFT JOIN load ON advocate_id = id
),
analysed AS (
    SELECT days_to_resolution AS days, csat_score AS csat, sla_breach_flag AS late, unnest([
        {{'kind': 'missing_docs_vs_resolution', 'use': resolved_at IS NOT NULL,
          'name': if(missing_docs, 'missing_docs', 'docs_complete')}},
        {{'kind': 'handoffs_vs_csat', 'use': csat_score IS NOT NULL,
          'name': if(handoff_count < 2, '0-1_handoffs', if(handoff_count < 3, '2_handoffs', '3+_handoffs'))}},
        {{'kind': 'case_type_vs_sla_breach', 'use': true, 'name': case_type}}]) AS part
    FROM case_lifecycle
),
bottlenecks AS (
    SELECT part.kind AS analysis_type, part.name AS segment, count(*) AS case_count,
           round({_mean("days")}, 2) AS avg_days_to_resolution,
           if(part.kind = 'case_type_vs_sla_breach', NULL, round({_mean("csat")}, 2)) AS avg_csat,
           if(part.kind = 'case_type_vs_sla_breach', round({_share(_times("late"), "count(*)")}, 2), NULL)
               AS sla_breach_pct
    FROM analysed WHERE part.use GROUP BY part
),
bottleneck_missing_docs AS (SELECT * FROM bottlenecks WHERE analysis_type = 'missing_docs_vs_resolution'),
bottleneck_handoffs AS (SELECT * FROM bottlenecks WHERE analysis_type = 'handoffs_vs_csat'),
bottleneck_case_type AS (SELECT * FROM bottlenecks WHERE analysis_type = 'case_type_vs_sla_breach'),
exec_headline AS (
    SELECT {_ACTIVE} AS active_cases, {_mean("days_to_resolution")} AS avg_days_to_resolution,
           {_share(_times("sla_breach_flag"), "count(*)")} AS sla_breach_rate_pct,
           {_mean("csat_score")} AS avg_csat, {_times("stale_case_flag")} AS stale_cases
    FROM case_lifecycle
)"""

PRELUDE = "WITH " + ",".join([_RAW.replace("{_DOCUMENT}", _DOCUMENT), _STAGING, _TIMINGS, _FACT, _MARTS]) + "\n"


def q(final_select: str) -> str:
    """Prefix a final SELECT with every shared CTE."""
    return PRELUDE + final_select


def csv_types_sql() -> str:
    """Type of every raw column, from its values' text by DuckDB's own casts."""
    rows = []
    for table, schema in schemas.RAW.items():
        for i, field in enumerate(schema.fields):
            v = f"nullif(trim(CAST({field.name} AS VARCHAR)), '')"
            rows.append(f"""
SELECT '{table}' AS raw_table, {i} AS position, '{field.name}' AS column_name,
  CASE WHEN count(v) = 0 THEN 'VARCHAR'
       WHEN bool_and(lower(v) IN ('true', 'false', 't', 'f')) THEN 'BOOLEAN'
       WHEN bool_and(TRY_CAST(v AS BIGINT) IS NOT NULL AND NOT regexp_matches(v, '[.eE]')) THEN 'BIGINT'
       WHEN bool_and(TRY_CAST(v AS DOUBLE) IS NOT NULL) THEN 'DOUBLE'
       WHEN bool_and(TRY_CAST(v AS DATE) IS NOT NULL AND length(v) <= 10) THEN 'DATE'
       WHEN bool_and(TRY_CAST(v AS TIMESTAMP) IS NOT NULL) THEN 'TIMESTAMP' ELSE 'VARCHAR' END AS type,
  count(v) AS value_count
FROM (SELECT {v} AS v FROM raw_{table}) WHERE v IS NOT NULL""")
    return " UNION ALL ".join(rows)


def flags_sql(start: str, clocks: int) -> str:
    """The fact's flags at every clock, each clock against every row."""
    return f"""
SELECT clock, case_type,
  count(*) FILTER (WHERE CASE WHEN resolved_at IS NOT NULL THEN days_to_resolution > 7
    ELSE date_diff('day', created_at::DATE, clock::DATE) > 7 END) AS late_cases,
  count(*) FILTER (WHERE resolved_at IS NULL
    AND date_diff('hour', coalesce(last_interaction_at, created_at), clock) > 48) AS stale_cases,
  count(*) FILTER (WHERE created_at <= clock AND (resolved_at IS NULL OR resolved_at > clock)) AS open_cases
FROM case_lifecycle,
  (SELECT TIMESTAMP '{start}' + to_days(CAST(i AS INTEGER)) AS clock FROM range({clocks}) AS r(i)) AS c
GROUP BY ALL"""
