"""Bind the driver's test tables to the six raw inputs (FIXTURES.md §2).

The reference reads six CSV extracts of a case-handling system.  The test
data is a TPC-H-like star schema, so each raw input is derived from one test
table by a fixed, deterministic rule.  Every binding is a narrow projection
of a parquet scan: Catalyst prunes the scan to the columns used and the rules
run inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Fixed values used by the bindings.
CHANNELS = ["phone", "email", "chat", "portal"]           # by c_custkey % 4
PATIENT_EPOCH = "2000-01-01"                              # created_at / hire_date base
FEEDBACK_EPOCH = "1998-01-01"                             # submitted_at base
META_INTAKE_SOURCE = "phone"
META_BARRIERS = ["language", "transportation", "cost", "health_literacy", "none"]
META_SUPPORT_FLAGS = ["", '"language"', '"transportation"', '"language","transportation"']  # by k % 4
META_SUBMITTED = "id_card"
META_COMPLEXITY = "high"
# Pinned clock for the bound tables.
AS_OF = "1998-06-15 12:30:00"


# Declared schemas of the test tables read here: no footer inference pass
# (at scale, inference would open files on the driver before planning).
TABLE_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def read_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None):
    """A test table as a streaming file source (new files are picked up as they land)."""
    reader = spark.readStream.schema(TABLE_SCHEMAS[name]).option("basePath", sf_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A one-character class turns the file name into a glob under basePath.
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by name, with its declared schema when known."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")



def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "c_mktsegment AS insurance_type",
        f"CASE c_custkey % 4 WHEN 0 THEN '{CHANNELS[0]}' WHEN 1 THEN '{CHANNELS[1]}' "
        f"WHEN 2 THEN '{CHANNELS[2]}' ELSE '{CHANNELS[3]}' END AS preferred_channel",
        "concat('S', CAST(c_nationkey AS STRING)) AS state",
        "c_acctbal / 10000D AS risk_score",
        f"CAST(date_sub(DATE '{PATIENT_EPOCH}', CAST(c_custkey % 700 AS INT)) AS TIMESTAMP_NTZ) AS created_at",
    )


def advocates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "concat(' ', c_name) AS name",
        "c_mktsegment AS specialty",
        "concat('team_', CAST(c_nationkey % 4 AS STRING)) AS team",
        "CAST(floor(abs(c_acctbal) / 1000D) AS INT) AS capacity",
        f"date_sub(DATE '{PATIENT_EPOCH}', CAST(c_custkey % 1000 AS INT)) AS hire_date",
    )


def _metadata_json_sql(k: str) -> str:
    """The metadata document as compact JSON text (FIXTURES.md §2).

    Built by concatenation, which gives the same text as ``to_json`` of the
    struct at a fraction of the per-row cost.  Some documents are absent,
    truncated or no object, and some fields hold what they should not, so the
    defaults and the reject counts of staging have work.
    """
    domain = ", ".join(f"'{b}'" for b in META_BARRIERS)
    barriers = (f"array_join(transform(sequence(0, CAST({k} % 3 AS INT)), i -> concat('\"', "
                f"element_at(array({domain}), CAST(1 + ({k} div 3 + (1 + {k} div 15 % 4) * i) % 5 AS INT)), '\"')), ',')")
    flags = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(META_SUPPORT_FLAGS))
    return (
        f"CASE WHEN {k} % 11 = 0 THEN NULL "
        f"WHEN {k} % 97 = 0 THEN '{{\"handoff_count\":' "
        f"WHEN {k} % 101 = 0 THEN '[1,2]' ELSE concat("
        f"'{{\"handoff_count\":', CASE WHEN {k} % 17 = 0 THEN '\"many\"' WHEN {k} % 19 = 0 THEN '\"2\"' "
        f"WHEN {k} % 23 = 0 THEN '99999999999' ELSE CAST({k} % 5 AS STRING) END, "
        f"',\"missing_docs\":', CASE WHEN {k} % 29 = 0 THEN '\"maybe\"' WHEN {k} % 3 = 0 THEN 'true' ELSE 'false' END, "
        f"CASE WHEN {k} % 7 <> 0 THEN ',\"complexity\":\"{META_COMPLEXITY}\"' ELSE '' END, "
        f"',\"intake_source\":\"{META_INTAKE_SOURCE}\"', "
        f"',\"barriers\":[', CASE WHEN {k} % 13 = 0 THEN '\"none\"' ELSE {barriers} END, "
        f"'],\"support_flags\":[', CASE {k} % 4 {flags} END, "
        f"'],\"submitted_documents\":[', CASE WHEN {k} % 3 = 1 THEN '\"{META_SUBMITTED}\"' ELSE '' END, ']}}') END"
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "o_orderkey"
    status = (
        f"CASE o_orderstatus "
        f"WHEN 'F' THEN CASE WHEN {k} % 12 = 0 THEN 'reopened' ELSE 'resolved' END "
        f"WHEN 'P' THEN CASE WHEN {k} % 2 = 0 THEN 'pending_docs' ELSE 'in_progress' END "
        f"WHEN 'O' THEN CASE WHEN {k} % 5 = 0 THEN 'escalated' ELSE 'open' END END"
    )
    created = (f"(o_orderdate + make_dt_interval(0, CAST({k} % 24 AS INT), "
               f"CAST({k} % 60 AS INT), 0))")
    return read_table(spark, sf_dir, "orders").selectExpr(
        f"{k} AS id",
        "o_custkey AS patient_id",
        "o_custkey AS advocate_id",
        "o_orderpriority AS case_type",
        f"CASE {k} % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS urgency",
        f"{status} AS status",
        f"{created} AS created_at",
        f"{created} + make_dt_interval(0, CAST({k} % 4 + 1 AS INT)) AS assigned_at",
        f"CASE WHEN o_orderstatus = 'F' THEN {created} + make_dt_interval(0, CAST({k} % 48 + 1 AS INT), 0, 0.25) END AS first_response_at",
        f"CASE WHEN o_orderstatus = 'F' THEN o_orderdate + make_dt_interval(CAST(({k} * 7) % 20 + 1 AS INT)) END AS resolved_at",
        f"CASE WHEN {k} % 4 = 0 THEN 1 ELSE 0 END AS escalation_flag",
        f"CASE WHEN {status} = 'reopened' THEN 1 ELSE 0 END AS reopen_flag",
        f"{_metadata_json_sql(k)} AS metadata_json",
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions_from(read_table(spark, sf_dir, "lineitem"))


def interactions_from(lineitem: DataFrame) -> DataFrame:
    """The interactions binding over a lineitem DataFrame (batch or streaming)."""
    return lineitem.selectExpr(
        "l_orderkey * 100 + l_linenumber AS id",
        "l_orderkey AS case_id",
        "CASE l_returnflag WHEN 'R' THEN 'call' WHEN 'A' THEN 'email' ELSE 'doc_request' END AS type",
        "l_shipdate AS created_at",
        "l_quantity AS duration_minutes",
        "l_suppkey AS advocate_id",
    )


def case_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return case_events_from(read_table(spark, sf_dir, "events"))


def case_events_from(events: DataFrame) -> DataFrame:
    """The case_events binding over an events DataFrame (batch or streaming)."""
    return events.selectExpr(
        "event_id AS id",
        "user_id AS case_id",
        "CASE event_type WHEN 'signup' THEN 'opened' WHEN 'view' THEN 'assigned' "
        "WHEN 'click' THEN 'first_response' WHEN 'error' THEN 'escalated' ELSE 'resolved' END "
        "AS event_type",
        "ts AS occurred_at",
    )


def patient_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per label; every tenth case answered twice (the fact fans out)."""
    csat = "least(5D, greatest(1D, 1D + 2D * quality + (doc_id % 5) * 0.5D - toxic - n * 0.5D))"
    labels = read_table(spark, sf_dir, "labels").selectExpr(
        "*", "explode(sequence(0, if(doc_id % 10 = 0, 1, 0))) AS n")
    return labels.selectExpr(
        "doc_id + n * 1000000000L AS id",
        "doc_id AS case_id",
        f"{csat} AS csat_score",
        f"CASE WHEN {csat} >= 4.5D THEN 'promoter' WHEN {csat} >= 3.5D THEN 'passive' "
        "ELSE 'detractor' END AS nps_bucket",
        "CASE WHEN doc_id % 2 = 0 THEN '' ELSE ' ok ' END AS feedback_text",
        f"CAST(date_add(DATE '{FEEDBACK_EPOCH}', CAST(doc_id % 90 AS INT)) AS TIMESTAMP_NTZ) "
        "AS submitted_at",
    )


BINDINGS = {
    "patients": patients,
    "advocates": advocates,
    "cases": cases,
    "interactions": interactions,
    "case_events": case_events,
    "patient_feedback": patient_feedback,
}


class RawTables(Mapping):
    """The six raw inputs, keyed like the reference's raw namespace; each
    binding is built on first access."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._sf_dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BINDINGS[name](self._spark, self._sf_dir)
        return self._built[name]

    def __iter__(self):
        return iter(BINDINGS)

    def __len__(self) -> int:
        return len(BINDINGS)


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """All six raw inputs (lazy mapping)."""
    return RawTables(spark, sf_dir)


def as_of_sql() -> str:
    return f"TIMESTAMP_NTZ '{AS_OF}'"
