"""The types and the dialect of a CSV found from the file itself.

*Types.*  Every cell is tested against a lattice of types, narrowest first:
BOOLEAN, BIGINT, DOUBLE, DATE, TIMESTAMP, and text, which holds anything.  A
cell gives a bit mask of the types it fits; a column's types are the bitwise
AND over all its rows, so one pass with map-side aggregation decides every
column over whole files, and no row is left unseen by a sample.  The narrowest
type left is the column's.  An empty cell is NULL and fits every type; a column
without a value is text.

*Dialect.*  The delimiter, and whether there is a header, are read off the
first lines of one file (``HEAD_LINES``, a documented bound: the dialect is a
property of the file, not of its rows).
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELIMITERS = [",", "|", ";", "\t"]
HEAD_LINES = 200

# Bits of the lattice, narrowest type first.
TYPES = ["BOOLEAN", "BIGINT", "DOUBLE", "DATE", "TIMESTAMP"]
SPARK_TYPES = {"BOOLEAN": "boolean", "BIGINT": "bigint", "DOUBLE": "double", "DATE": "date",
               "TIMESTAMP": "timestamp_ntz", "VARCHAR": "string"}
ALL = (1 << len(TYPES)) - 1

_DAY = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
# A cell's shape is checked before the cast: casts accept more than a CSV type
# is meant to (a bare year as a date, a trailing d in a double).
_SHAPES = {
    "BOOLEAN": ("(?i)^(true|false|t|f)$", None),
    "BIGINT": (r"^[+-]?[0-9]+$", "bigint"),
    "DOUBLE": (r"(?i)^[+-]?(([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)$", "double"),
    "DATE": (f"^{_DAY}$", "date"),
    "TIMESTAMP": (f"^{_DAY}([ T][0-9]{{1,2}}:[0-9]{{2}}(:[0-9]{{2}}(\\\\.[0-9]+)?)?)?$", "timestamp_ntz"),
}


@dataclass(frozen=True)
class Dialect:
    """How a CSV is cut into cells."""

    delimiter: str
    header: bool
    names: tuple[str, ...]

    @property
    def options(self) -> dict[str, str]:
        return {"sep": self.delimiter, "header": str(self.header).lower(), "quote": '"', "escape": '"'}


def fits_sql(cell: str) -> str:
    """Bit mask of the types that the text ``cell`` fits; all for NULL or ''.

    A cell meets only the tests its first character allows, and a shape rules
    others out: digits alone are no date, and what has a date's shape no number.
    A day has at most 10 characters and a line end, with a time 13 at least.
    """
    x = f"trim({cell})"
    bit = {name: 1 << i for i, name in enumerate(TYPES)}

    def shaped(name: str) -> str:
        return f"{x} RLIKE '{_SHAPES[name][0]}'"

    def casts(name: str) -> str:
        return f"if(try_cast({x} AS {_SHAPES[name][1]}) IS NOT NULL, {bit[name]}, 0)"

    first = f"ascii({x})"
    double = f"if({shaped('DOUBLE')}, {casts('DOUBLE')}, 0)"
    number = f"CASE WHEN {shaped('BIGINT')} THEN {casts('BIGINT')} + {casts('DOUBLE')} ELSE {double} END"
    return (
        f"CASE WHEN {cell} IS NULL OR {x} = '' THEN {ALL} "
        f"WHEN {first} BETWEEN 48 AND 57 THEN CASE WHEN {shaped('TIMESTAMP')} "  # 0 to 9
        f"THEN if(length({x}) < 13, {casts('DATE')}, 0) + {casts('TIMESTAMP')} ELSE {number} END "
        f"WHEN {first} IN (43, 45, 46) THEN {number} "  # + - .
        f"WHEN {first} IN (73, 78, 105, 110) THEN {double} "  # I N i n
        f"WHEN {first} IN (70, 84, 102, 116) THEN if({shaped('BOOLEAN')}, {bit['BOOLEAN']}, 0) "  # F T f t
        f"ELSE 0 END")


def type_sql(mask: str, values: str) -> str:
    """The narrowest type of a column's mask; text where it has no value."""
    whens = " ".join(f"WHEN {mask} & {1 << i} <> 0 THEN '{name}'" for i, name in enumerate(TYPES))
    return f"CASE WHEN {values} = 0 THEN 'VARCHAR' {whens} ELSE 'VARCHAR' END"


def column_types(cells: DataFrame) -> DataFrame:
    """(position, column_name, type, value_count) of a table of text cells.

    One aggregation over every row; the result has a row per column.
    """
    n = len(cells.columns)
    masks = cells.agg(*[
        F.expr(e) for i, c in enumerate(cells.columns) for e in (
            f"coalesce(bit_and({fits_sql(f'`{c}`')}), {ALL}) AS m{i}",
            f"count_if(`{c}` IS NOT NULL AND trim(`{c}`) <> '') AS v{i}")])
    rows = ", ".join(
        f"named_struct('position', {i}, 'column_name', '{_quoted(c)}', 'type', {type_sql(f'm{i}', f'v{i}')}, "
        f"'value_count', v{i})" for i, c in enumerate(cells.columns))
    return masks.selectExpr(f"inline(array({rows}))") if n else masks


def _quoted(name: str) -> str:
    return name.replace("\\", "\\\\").replace("'", "\\'")


def _cut(lines: list[str], delimiter: str) -> list[list[str]]:
    rows = list(csv.reader((line + "\n" for line in lines), delimiter=delimiter))
    if len(lines) == HEAD_LINES:
        rows = rows[:-1]  # the last record may be cut off
    return [r for r in rows if r]


def sniff_dialect(spark: SparkSession, path: str) -> Dialect:
    """Delimiter and header of the CSV at ``path``.

    The delimiter is the one that cuts most of the first records into one and
    the same number of cells, above one if any does.  The first record is a
    header if its cells are all there, differ, and some column would lose its
    type with them, or if every column is text anyway.
    """
    # The first file only: its lines lie together at its start.
    found = spark.read.text(path)
    first = min(found.inputFiles(), default=None)
    if first is None:
        raise ValueError(f"{path}: no file")
    lines = [r.value.rstrip("\r") for r in spark.read.option("lineSep", "\n").text(first).limit(HEAD_LINES).collect()]
    if not lines:
        raise ValueError(f"{path}: empty file")

    def score(delimiter: str) -> tuple[bool, float, int]:
        widths = [len(r) for r in _cut(lines, delimiter)]
        usual = max(set(widths), key=lambda w: (widths.count(w), w)) if widths else 0
        return usual > 1, widths.count(usual) / max(1, len(widths)), usual

    delimiter = max(DELIMITERS, key=score)
    rows = _cut(lines, delimiter)
    head, body = rows[0], [r for r in rows[1:] if len(r) == len(rows[0])]
    named = all(c.strip() for c in head) and len(set(head)) == len(head)
    if named and body:
        # Types of the body's cells against those of the head's, by the lattice.
        cells = spark.createDataFrame(body, T.StructType([T.StructField(f"c{i}", T.StringType())
                                                          for i in range(len(head))]))
        types = [r.type for r in column_types(cells).orderBy("position").collect()]
        own = spark.createDataFrame([head], cells.schema)
        own_types = [r.type for r in column_types(own).orderBy("position").collect()]
        typed = [i for i, t in enumerate(types) if t != "VARCHAR"]
        header = any(own_types[i] == "VARCHAR" for i in typed) or not typed
    else:
        header = named and not body
    return Dialect(delimiter, header, tuple(head if header else (f"column{i}" for i in range(len(head)))))


def _cells(spark: SparkSession, path: str, dialect: Dialect) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in dialect.names])
    return spark.read.options(**dialect.options, enforceSchema="true").schema(schema).csv(path)


def sniff(spark: SparkSession, path: str) -> DataFrame:
    """(position, column_name, type, value_count) of the CSV at ``path``, whole."""
    return column_types(_cells(spark, path, sniff_dialect(spark, path)))


def read_csv_auto(spark: SparkSession, path: str) -> DataFrame:
    """The CSV with sniffed dialect and types; two passes over the files.

    Where a table is declared, ``files.read_raw_csv`` needs one pass only.
    """
    dialect = sniff_dialect(spark, path)
    cells = _cells(spark, path, dialect)
    # One row per column reaches the driver.
    types = {r.position: r.type for r in column_types(cells).collect()}
    return cells.selectExpr(*[
        f"`{n}`" if types[i] == "VARCHAR" else f"CAST(nullif(trim(`{n}`), '') AS {SPARK_TYPES[types[i]]}) AS `{n}`"
        for i, n in enumerate(dialect.names)])
