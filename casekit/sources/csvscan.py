"""S1 + S3: CSV files with line breaks inside quotes, read by many tasks.

Spark's ``multiLine`` reads a file in one task, as a split cannot tell whether
it begins inside quotes.  Here it can: every split counts its quotes, the
parities of the splits before it in the file give the state at its start (a
table of one row a split), and each split then cuts its own lines into records
with a running parity.  Records that cross a split's edge come out as
fragments, at most two a split, and are joined afterwards.  A doubled quote
inside a cell counts twice, so it does not change the parity.

Files are plain text in UTF-8 without compression; a line ends with LF or CRLF.
Inside quotes a CRLF is kept as it is (``multiLine`` would make it LF).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the lines of each split, in order, CR kept."""
    return spark.read.option("lineSep", "\n").text(path).selectExpr(
        "_metadata.file_path AS file", "_metadata.file_block_start AS block", "value")


def split_states(lines: DataFrame, quote: str = QUOTE) -> DataFrame:
    """(file, block, inside): whether a split begins inside quotes.

    One row a split: the window orders a file's splits, not its lines.
    """
    quotes = f"length(value) - length(replace(value, '{quote}', ''))"
    odd = lines.groupBy("file", "block").agg(F.expr(f"sum({quotes}) % 2 AS odd"))
    before = "sum(odd) OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return odd.selectExpr("file", "block", f"coalesce({before}, 0) % 2 = 1 AS inside")


def quoted_records(spark: SparkSession, path: str, quote: str = QUOTE) -> DataFrame:
    """(file, head, record): every record of the CSV files under ``path``.

    ``head`` marks the first record of a file.  Records keep their inner line
    breaks; blank lines between records are left out.
    """
    lines = _lines(spark, path)
    # One row a split (128 MB by default): bounded by the input's size / 128 MB.
    stated = lines.join(F.broadcast(split_states(lines, quote)), ["file", "block"])
    mark = quote.encode()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records, and the fragments at a split's edges: ``part`` is 0 for a
        whole record, 1 for the end of one begun earlier, 2 for the start of
        one that may go on in the next split."""
        now, inside, begun, held, first = None, False, False, [], False
        out: dict[str, list] = {k: [] for k in ("file", "block", "part", "head", "record")}

        def put(part: int, rows: list[bytes]) -> None:
            nonlocal first
            text = b"\n".join(rows)
            if part == 0:
                text = text[:-1] if text.endswith(b"\r") else text
                if not text:
                    return
            for name, value in zip(out, (now[0], now[1], part, first, text)):
                out[name].append(value)
            first = False

        def flush() -> None:
            """End of a split: what is held may go on in the next one."""
            if now is not None and held:
                put(2 if begun else 1, held)

        def batch_out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(out["file"], pa.string()), pa.array(out["block"], pa.int64()),
                 pa.array(out["part"], pa.int32()), pa.array(out["head"], pa.bool_()),
                 pa.array(out["record"], pa.binary()).cast(pa.string())], names=list(out))
            for rows in out.values():
                rows.clear()
            return made

        for batch in batches:
            values = batch.column("value").cast(pa.binary())
            odd = pc.count_substring(values, mark).to_numpy(zero_copy_only=False) % 2
            files, blocks, starts = (batch.column(c).to_pylist() for c in ("file", "block", "inside"))
            texts = values.to_pylist()
            at = 0
            while at < len(texts):
                here = (files[at], blocks[at])
                if here != now:
                    flush()
                    now, inside, held = here, starts[at], []
                    begun, first = not inside, here[1] == 0
                end = at + 1
                while end < len(texts) and (files[end], blocks[end]) == here:
                    end += 1
                state = (np.cumsum(odd[at:end]) + inside) % 2  # 1: inside after the line
                for i, still in zip(range(at, end), state.tolist()):
                    held.append(texts[i])
                    if not still:
                        put(0 if begun else 1, held)
                        held, begun = [], True
                inside = bool(state[-1])
                at = end
            yield batch_out()
        flush()
        yield batch_out()

    cells = stated.mapInArrow(cut, "file string, block bigint, part int, head boolean, record string")
    edges = cells.where("part > 0")
    # A record's number among those that cross an edge: starts counted so far.
    # At most two fragments a split are ordered here.
    number = "sum(CAST(part = 2 AS INT)) OVER (PARTITION BY file ORDER BY block, part)"
    joined = (
        edges.withColumn("n", F.expr(number)).groupBy("file", "n")
        .agg(F.sort_array(F.collect_list(F.struct("block", "part", "record"))).alias("parts"),
             F.expr("bool_or(head AND part = 2)").alias("head"))
        .selectExpr("file", "head", "regexp_replace(array_join(transform(parts, p -> p.record), '\\n'), '\\r$', '')"
                    " AS record")
    )
    return cells.where("part = 0").select("file", "head", "record").union(joined.where("record <> ''"))


def read_quoted_csv(spark: SparkSession, path: str, corrupt: str, options: dict[str, str] | None = None) -> DataFrame:
    """The CSV's cells as text under its header's names, plus ``corrupt``.

    Every file's header must be the first one's.
    """
    given = {"quote": QUOTE, "escape": QUOTE, **(options or {})}
    rows = quoted_records(spark, path, given["quote"])
    # ``multiLine`` reads one line of a header here: the names, no data.
    names = spark.read.options(header="true", multiLine="true", enforceSchema="false", **given).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, corrupt]])
    parsed = rows.select("head", F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), {
        **given, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}).alias("c"))
    cells = " AND ".join(f"trim(c.`{n}`) <=> '{n}'" for n in names)
    wrong = f"head AND NOT ({cells})"
    return parsed.where(
        f"NOT head OR CASE WHEN {wrong} THEN raise_error('a file has another header') IS NULL ELSE false END"
    ).select("c.*")
