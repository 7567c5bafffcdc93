"""Copies of stored tables that a look-up reads only in part.

``write`` copies a stored table into files that each hold one range of the
cluster columns (all rows in order, ties as well), with small row groups and
Parquet Bloom filters, and then gathers one row of statistics per file: its
name, rows, and each cluster column's smallest and largest value and nulls.
``Clustered`` reads back only the files whose range can hold what is asked
for; in those, Spark's pushed filter skips row groups by their minimum and
maximum and by Bloom filter.  Ranges of files do not overlap but for ties, so
a look-up of one key opens the same number of files however long the table is;
only the list of statistics, one row per file, grows.

* The number of ranges comes from the table's bytes and rows, never from its
  rows' keys: stored bytes say little of what a task sorts, as a table may be
  stored in a tenth of that.
* Rows of one key are spread over ranges by the row's place in the stored table
  (file and row number), so a key that holds a third of all rows fills as many
  files as its rows need, and no task gets more than its share.
* A null is the smallest value.  An empty table is copied as an empty table.
* The place is read from the stored files, so a task that runs again deals its
  rows as before; what a failed write left is never read, as the statistics come
  last.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casekit.sources import storage

FILE_BYTES = 128 << 20  # of the stored table, per range at most
SORT_BYTES = 128 << 20  # of the rows in memory, per range at most
CELL_BYTES = 12  # of a value in memory, about
ROW_GROUP_BYTES = 16 << 20
STATISTICS = "_statistics"  # below the copy; names with _ are no data to Spark
# More values than this are not pushed as a list to the scan.
MAX_KEYS = 10


def _statistics_schema(schema: StructType, by: list[str]) -> StructType:
    out = StructType().add("file_name", "string").add("n_rows", "long")
    for c in by:
        out = out.add(f"min_{c}", schema[c].dataType).add(f"max_{c}", schema[c].dataType).add(f"nulls_{c}", "long")
    return out


def _statistics(df: DataFrame, by: list[str]) -> DataFrame:
    sql = ["count(1) AS n_rows"]
    for c in by:
        sql += [f"min(`{c}`) AS `min_{c}`", f"max(`{c}`) AS `max_{c}`", f"count_if(`{c}` IS NULL) AS `nulls_{c}`"]
    return df.groupBy(F.expr("_metadata.file_name AS file_name")).agg(*[F.expr(s) for s in sql])


def write(spark: SparkSession, source: str, schema: StructType, path: str, by: list[str], bloom: list[str],
          file_bytes: int = FILE_BYTES, row_group_bytes: int = ROW_GROUP_BYTES,
          sort_bytes: int = SORT_BYTES) -> int:
    """Copy the Parquet table at ``source`` to ``path``; the number of files."""
    table = spark.read.schema(schema).parquet(source)
    total = sum(length for length, _ in storage.input_states(spark, table).values())
    sorted_bytes = table.count() * len(schema) * CELL_BYTES
    ranges = max(1, math.ceil(total / file_bytes), math.ceil(sorted_bytes / sort_bytes))
    place = F.expr("struct(xxhash64(_metadata.file_path) AS f, _metadata.row_index AS r)")
    placed = table.select("*", place.alias("_place"))
    if ranges > 1:
        placed = placed.repartitionByRange(ranges, *by, "_place")
    else:
        placed = placed.coalesce(1)
    writer = (placed.sortWithinPartitions(*by, "_place").drop("_place").write.mode("overwrite")
              .option("parquet.block.size", row_group_bytes))
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    copy = spark.read.schema(schema).parquet(path)
    _statistics(copy, by).coalesce(1).write.mode("overwrite").parquet(f"{path}/{STATISTICS}")
    return ranges


class Clustered:
    """A copy that ``write`` made, read in part."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, by: list[str]) -> None:
        self._spark, self._path, self._schema, self._by = spark, path, schema, by

    def statistics(self) -> DataFrame:
        """A row per file; this reads one small table."""
        return (self._spark.read.schema(_statistics_schema(self._schema, self._by))
                .parquet(f"{self._path}/{STATISTICS}"))

    def files(self, where: str) -> list[str]:
        """Files whose statistics satisfy ``where``, in order."""
        rows = self.statistics().filter(where).select("file_name").collect()
        return sorted(f"{self._path}/{r.file_name}" for r in rows)

    def _read(self, where: str) -> DataFrame:
        files = self.files(where)
        if not files:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*files)

    def _literal(self, column: str, value: object) -> str:
        kind = self._schema[column].dataType.simpleString()
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"CAST('{text}' AS {kind})"

    def equal(self, column: str, *values: object) -> DataFrame:
        """All rows whose cluster column has one of a few values (None: null)."""
        if len(values) > MAX_KEYS:
            raise ValueError(f"at most {MAX_KEYS} values; join the table with the keys instead")
        known = [self._literal(column, v) for v in values if v is not None]
        spans = [f"{v} BETWEEN `min_{column}` AND `max_{column}`" for v in known]
        rows = [f"`{column}` IN ({', '.join(known)})"] if known else []
        if any(v is None for v in values):
            spans.append(f"`nulls_{column}` > 0")
            rows.append(f"`{column}` IS NULL")
        if not rows:
            return self._spark.createDataFrame([], self._schema)
        return self._read(" OR ".join(spans)).filter(" OR ".join(rows))

    def between(self, column: str, low: object, high: object) -> DataFrame:
        """All rows whose cluster column lies in a closed range."""
        a, b = self._literal(column, low), self._literal(column, high)
        return self._read(f"`max_{column}` >= {a} AND `min_{column}` <= {b}").filter(f"`{column}` BETWEEN {a} AND {b}")
