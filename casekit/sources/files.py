"""Raw-table sources and sinks (S1–S6, S13) and catalog helpers.

CSV is read with an explicit schema (no inference pass) and RFC-4180
quoting: a JSON document inside a cell keeps its commas and doubled quotes.
Timestamps are read as text and cast by staging, which accepts both the
``T`` and the space separator and any fraction length; they are written with
full microsecond precision so a round trip is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from casekit import schemas
from casekit.sources import csvscan

# The reference's raw registry (table -> file name).
RAW_FILES = {
    "patients": "patients.csv",
    "advocates": "advocates.csv",
    "cases": "cases.csv",
    "interactions": "interactions.csv",
    "case_events": "case_events.csv",
    "patient_feedback": "patient_feedback.csv",
}

CORRUPT = "__corrupt_record"
CSV_READ_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # Every file's header must be the first one's, and a row is judged by all
    # its cells whatever columns a query needs.
    "enforceSchema": "false", "columnPruning": "false",
}
CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
}


def text_timestamps(schema: T.StructType) -> T.StructType:
    """The schema with every timestamp column read as text (staging casts it)."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
                      else f.dataType, f.nullable)
        for f in schema.fields
    ])


def _csv_text(spark: SparkSession, path: str, table: str, multi_line: bool) -> DataFrame:
    """The CSV's cells as text under its own header names, plus ``CORRUPT``."""
    reader = spark.read.options(**CSV_READ_OPTIONS)
    names = reader.csv(path).columns  # reads one header line
    missing = [f.name for f in schemas.RAW[table].fields if f.name not in names]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header")
    if multi_line:
        return csvscan.read_quoted_csv(spark, path, CORRUPT)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    return reader.schema(schema).csv(path)


def _cell(name: str, kind: str, strict: bool) -> str:
    if kind == "string":
        return f"`{name}`"
    cast = f"try_cast(trim(`{name}`) AS {kind})"
    if not strict:
        return cast
    return (f"CASE WHEN `{name}` IS NOT NULL AND {cast} IS NULL THEN CAST(raise_error(concat("
            f"'bad {name}: ', `{name}`)) AS {kind}) ELSE {cast} END")


def read_raw_csv(spark: SparkSession, path: str, table: str, multi_line: bool = False,
                 strict: bool = True) -> DataFrame:
    """One raw CSV (header, quoted JSON, empty = NULL, CRLF or LF).

    Columns are taken by header name, in any order; columns the table does not
    know are ignored.  ``strict`` (the default) fails the load at the first
    broken row or cell that is not of its type; otherwise such rows are left
    out and such cells are NULL, and ``csv_rejects`` counts both.

    ``multi_line`` allows line breaks inside quoted cells; files are split
    between tasks all the same (``sources.csvscan``), at the price of reading
    them twice.
    """
    text = _csv_text(spark, path, table, multi_line)
    # Spark wants a data column read along with the corrupt record, also where
    # a query (a count) needs none.
    whole = f"length(concat('.', coalesce(`{text.columns[0]}`, ''))) > 0"
    if strict:
        keep = f"CASE WHEN {CORRUPT} IS NOT NULL THEN raise_error(concat('broken row: ', {CORRUPT})) IS NULL ELSE {whole} END"
    else:
        keep = f"{CORRUPT} IS NULL AND {whole}"
    return text.where(keep).selectExpr(*[
        f"{_cell(f.name, f.dataType.simpleString(), strict)} AS `{f.name}`"
        for f in text_timestamps(schemas.RAW[table]).fields])


def csv_rejects(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """One row: rows of the CSV, broken rows, and cells that are not of their type."""
    bad = " + ".join(
        f"count_if({CORRUPT} IS NULL AND `{f.name}` IS NOT NULL AND {_cell(f.name, f.dataType.simpleString(), False)} IS NULL)"
        for f in text_timestamps(schemas.RAW[table]).fields if not isinstance(f.dataType, T.StringType))
    return _csv_text(spark, path, table, multi_line).selectExpr(
        f"'{table}' AS raw_table", "count(1) AS row_count", f"count({CORRUPT}) AS broken_rows", f"{bad} AS bad_cells")


def read_raw_tables(spark: SparkSession, folder: str, fmt: str = "csv", multi_line: bool = False,
                    strict: bool = True) -> dict[str, DataFrame]:
    """Every raw table of the registry from ``folder`` (CSV or Parquet).

    Parquet columns are cast to the declared types, whatever the files have.
    """
    out = {}
    for table, filename in RAW_FILES.items():
        if fmt == "csv":
            out[table] = read_raw_csv(spark, f"{folder}/{filename}", table, multi_line, strict)
        else:
            out[table] = spark.read.parquet(f"{folder}/{table}.parquet").selectExpr(*[
                f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                for f in schemas.RAW[table].fields])
    return out


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index; full refresh of the target."""
    writer = df.write.mode("overwrite")
    for k, v in CSV_WRITE_OPTIONS.items():
        writer = writer.option(k, v)
    writer.csv(path)


def write_raw_tables(raw: dict[str, DataFrame], folder: str) -> None:
    """S6 + S13: replace every raw CSV of the registry under ``folder``."""
    for table, filename in RAW_FILES.items():
        if table in raw.keys():
            write_csv(raw[table], f"{folder}/{filename}")


def table_or_empty(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The table if it exists, else an empty DataFrame with ``schema``."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], schema)


def query_or_empty(spark: SparkSession, sql: str, schema: T.StructType) -> DataFrame:
    """An ad-hoc SQL query, or an empty DataFrame with ``schema`` when a
    table it reads does not exist (any other error is raised)."""
    from pyspark.errors import AnalysisException

    try:
        return spark.sql(sql)
    except AnalysisException as exc:
        if exc.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet folder at ``path``, or None when there is none."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def mart_ready(spark: SparkSession, path: str) -> bool:
    """S12 + O4: the stored mart exists and a one-row read succeeds (no row is
    needed: an empty mart is ready)."""
    from py4j.protocol import Py4JError
    from pyspark.errors import PySparkException

    try:
        mart = read_or_none(spark, path)
        if mart is None:
            return False
        mart.limit(1).collect()
    except (PySparkException, Py4JError):  # unreadable
        return False
    return True


def readiness(spark: SparkSession, marts: dict[str, str]) -> DataFrame:
    """S12 as a DataFrame: (mart, ready) for each named path."""
    rows = [(name, mart_ready(spark, path)) for name, path in marts.items()]
    return spark.createDataFrame(rows, "mart string, ready boolean")
