"""Operator 9: WARC archives and their merged index.

``write_archives`` turns pages into WARC/1.1 records, one archive per task,
each sorted by URL key and capture time: a locally sorted run.  Repeated
payloads become revisit records.  The archives are plain gzip text files
written through Spark's committer: a record is one line whose terminator is
the record separator CRLF CRLF, so task retries leave no partial archive.
``read_archives`` streams them back, record by record, by Content-Length.
``merge_runs`` turns the runs' captures into one globally ordered index:
range partitions by (URL key, time, page) and, inside each, a k-way merge of
the run pieces with a loser tree.

Defined results: a null html is an empty payload; a null url is an empty key
and no target header; a null page_id is written without an id, is never
referred to and sorts first.  Rows with equal page_id and payload are separate
captures.  An empty table gives an empty index.  Extra columns are ignored.
Capture times are derived from page_id because pages carry none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casekit.llm.common import prepare, sized, stored, table
from casekit.plans.pipeline import scratch_path

MIN_DEDUP_BYTES = 1000
SEPARATOR = "\r\n\r\n"
EPOCH = 1577836800  # 2020-01-01, the first capture time

CAPTURE = ("urlkey string, ts string, page_id bigint, record_type string, refers_to bigint, "
           "payload_bytes bigint, payload_digest string, run string, seq bigint, "
           "rec_offset bigint, rec_length bigint")

# scheme://host/rest -> host labels reversed, without www.; no fragment.
_URL = r"regexp_replace(coalesce(`url`, ''), '[\\x00-\\x20]', '%20')"
_HOST = r"regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"
_REST = r"regexp_replace(regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '#.*$', '')"


def records(pages: DataFrame, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """Pages with digest, key, capture time and record type.

    Only payloads that occur more than once are looked up: a small side that
    is broadcast if its count allows; otherwise the join's hot digests are
    split by adaptive execution.
    """
    body = "encode(coalesce(`html`, ''), 'UTF-8')"
    base = pages.selectExpr(
        "cast(`page_id` as bigint) AS page_id", f"{_URL} AS u", "coalesce(`html`, '') AS html",
        f"cast(octet_length({body}) as bigint) AS n", f"sha1({body}) AS digest")
    repeated = stored(
        base.where(f"n >= {min_bytes}").groupBy("digest")
        .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("c"))
        .where("c > 1 AND holder IS NOT NULL").select("digest", "holder"), "warc-repeated")
    return (
        base.join(sized(repeated), "digest", "left")
        .withColumn("revisit", F.expr(
            f"n >= {min_bytes} AND holder IS NOT NULL AND NOT (page_id <=> holder)"))
        .withColumn("urlkey", F.expr(
            f"if(u = '', '', concat(array_join(reverse(split({_HOST}, '\\\\.')), ','), ')', {_REST}))"))
        .withColumn("t", F.expr(
            f"timestamp_seconds({EPOCH} + pmod(coalesce(page_id, 0), 1000000000))"))
    )


def _record_text() -> str:
    """SQL for the whole text of a record, without its separator."""
    crlf = "'\\r\\n'"
    http = (f"concat('HTTP/1.1 200 OK', {crlf}, 'Content-Type: text/html; charset=utf-8', {crlf}, "
            f"'Content-Length: ', n, {crlf}, {crlf})")
    block = f"concat({http}, if(revisit, '', html))"
    return (
        f"concat('WARC/1.1', {crlf}, 'WARC-Type: ', if(revisit, 'revisit', 'response'), {crlf}, "
        f"'WARC-Record-ID: <urn:page:', coalesce(cast(page_id as string), ''), '>', {crlf}, "
        f"'WARC-Date: ', date_format(t, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), {crlf}, "
        f"if(u = '', '', concat('WARC-Target-URI: ', u, {crlf})), "
        f"'WARC-Payload-Digest: sha1:', digest, {crlf}, "
        f"if(revisit, concat('WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
        f"identical-payload-digest', {crlf}, 'WARC-Refers-To: <urn:page:', holder, '>', {crlf}), ''), "
        f"'X-Url-Key: ', urlkey, {crlf}, "
        f"'Content-Type: application/http; msgtype=response', {crlf}, "
        f"'Content-Length: ', octet_length(encode({block}, 'UTF-8')), {crlf}, {crlf}, {block})"
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_DEDUP_BYTES) -> None:
    """Write one sorted archive per task (gzip, not splittable: read in order)."""
    (
        records(pages, min_bytes)
        .sortWithinPartitions("urlkey", "t", "page_id")
        .selectExpr(f"{_record_text()} AS value")
        .write.option("lineSep", SEPARATOR).option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED").text(path)
    )


class _Archive:
    """Reads records from the pieces between separators, across batches.

    Pieces and separators are joined again and records cut by their
    Content-Length, so separators inside a payload do no harm.
    """

    def __init__(self) -> None:
        self.run, self.offset, self.seq = None, 0, 0
        self.pieces: list[bytes] = []
        self.size = self.need = 0
        self.head: dict[str, str] | None = None

    def feed(self, run: str, piece: bytes):
        if run != self.run:
            if self.head is not None:
                raise ValueError(f"archive {self.run} ends inside a record")
            self.__init__()
            self.run = run
        self.pieces.append(piece + b"\r\n\r\n")
        self.size += len(piece) + 4
        while True:
            if self.head is None:
                data = b"".join(self.pieces)
                skip = len(data) - len(data.lstrip(b"\r\n"))
                end = data.find(b"\r\n\r\n", skip)
                if end < 0:
                    self.pieces, self.size = [data], len(data)
                    return
                self.offset += skip
                lines = data[skip:end].decode("utf-8").split("\r\n")
                self.head = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
                self.need = end + 4 + int(self.head["Content-Length"])
                self.body, self.skip = end + 4, skip
                self.pieces, self.size = [data], len(data)
            if self.size < self.need + 4:  # with its separator
                return
            data = b"".join(self.pieces)
            yield self.head, data[self.body:self.need], self.offset, self.need - self.skip, self.seq
            self.offset += self.need + 4 - self.skip
            self.seq += 1
            data = data[self.need + 4:]
            self.pieces, self.size, self.head = [data] if data else [], len(data), None


def _id(text: str | None) -> int | None:
    digits = (text or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _capture(head: dict, block: bytes, offset: int, length: int, run: str, seq: int) -> tuple:
    """Index row of a record; the digest is taken from the bytes when they are there."""
    top, _, payload = block.partition(b"\r\n\r\n")
    declared = head["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(top.rsplit(b"Content-Length: ", 1)[1])
    if head["WARC-Type"] == "response":
        digest = hashlib.sha1(payload).hexdigest()
        if digest != declared or size != len(payload):
            raise ValueError(f"damaged record {head['WARC-Record-ID']} in {run}")
        refers = None
    else:
        digest, refers = declared, _id(head["WARC-Refers-To"])
    ts = "".join(c for c in head["WARC-Date"] if c.isdigit())
    return (head.get("X-Url-Key", ""), ts, _id(head["WARC-Record-ID"]), head["WARC-Type"],
            refers, size, digest, run, seq, offset, length)


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(cols, types)], schema=types)


_TYPES = pa.schema([
    ("urlkey", pa.string()), ("ts", pa.string()), ("page_id", pa.int64()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("run", pa.string()), ("seq", pa.int64()),
    ("rec_offset", pa.int64()), ("rec_length", pa.int64())])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One capture per record, in archive order (columns of ``CAPTURE``).

    Offsets and lengths count the bytes before compression.
    """
    pieces = (
        spark.read.option("lineSep", SEPARATOR).text(path)
        .selectExpr("_metadata.file_name AS run", "cast(value as binary) AS piece"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = _Archive()
        for batch in batches:
            rows = []
            for run, piece in zip(batch.column("run").to_pylist(), batch.column("piece")):
                for head, block, offset, length, seq in archive.feed(run, piece.as_py()):
                    rows.append(_capture(head, block, offset, length, run, seq))
            if rows:
                yield _batch(rows, _TYPES)
        if archive.head is not None:
            raise ValueError(f"archive {archive.run} ends inside a record")

    return pieces.mapInArrow(parse, CAPTURE)


def loser_tree_merge(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs: each inner node keeps the loser of its match.

    After the winner's run advances only its path to the root is replayed,
    log2(k) comparisons a row.
    """
    k = len(runs)
    if not k:
        return
    at = [0] * k

    def head(r: int) -> tuple:  # an exhausted run loses to all others
        return (0, runs[r][at[r]], r) if at[r] < len(runs[r]) else (1, (), r)

    heads = [head(r) for r in range(k)]
    # Leaves k..2k-1, inner nodes 1..k-1; play all matches bottom-up.
    losers, winner = [0] * k, [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        first = a if heads[a] <= heads[b] else b
        winner[node], losers[node] = first, a + b - first
    top = winner[1] if k > 1 else 0
    while heads[top][0] == 0:
        yield heads[top][1]
        at[top] += 1
        heads[top] = head(top)
        node = (top + k) // 2
        while node:
            if heads[losers[node]] < heads[top]:
                losers[node], top = top, losers[node]
            node //= 2


def merge_runs(captures: DataFrame, rows_per_range: int = 20_000) -> DataFrame:
    """Captures of all runs in global order, with ``position`` from 0.

    ``captures`` is a stored table.  Ranges are cut by the whole sort key, so
    a host or URL with a third of all captures spans many ranges, and so do
    repeated captures of one page.
    """
    n = max(1, -(-captures.count() // rows_per_range))
    key = ["urlkey", "ts", "page_id", "run", "seq"]
    ranged = (
        captures.repartitionByRange(n, *key)
        .withColumn("range_no", F.spark_partition_id())
        .sortWithinPartitions("run", "seq"))
    names = [f.name for f in _TYPES]
    out_types = _TYPES.append(pa.field("range_no", pa.int32())).append(pa.field("local", pa.int64()))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        range_no = 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in names]
            if batch.num_rows:
                range_no = batch.column("range_no")[0].as_py()
            for row in zip(*cols):
                page = row[2]
                order = (row[0], row[1], page is not None, page or 0, row[7], row[8])
                runs.setdefault(row[7], []).append((order, row))
        rows, local = [], 0
        for _, row in loser_tree_merge(list(runs.values())):
            rows.append((*row, range_no, local))
            local += 1
            if len(rows) == 4096:
                yield _batch(rows, out_types)
                rows = []
        if rows:
            yield _batch(rows, out_types)

    merged = stored(
        ranged.mapInArrow(merge, f"{CAPTURE}, range_no int, local bigint"), "warc-index")
    # One row per range: a running count over them places each range.
    sizes = merged.groupBy("range_no").agg(F.count(F.lit(1)).alias("n"))
    starts = stored(sizes.selectExpr(
        "range_no", "sum(n) OVER (ORDER BY range_no) - n AS start"), "warc-starts")
    return (
        merged.join(sized(starts), "range_no")
        .withColumn("position", F.expr("start + local"))
        .drop("range_no", "local", "start", "n")
    )


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """Contract query: write the archives, read them back, merge the index."""
    prepare(spark)
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    captures = stored(read_archives(spark, path), "warc-captures")
    return merge_runs(captures).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        "urlkey", "position")


ORACLE = rf"""
WITH p AS (
  SELECT page_id, regexp_replace(coalesce(url, ''), '[\x00-\x20]', '%20', 'g') AS u,
    coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d
  FROM pages
), h AS (
  SELECT d, max(page_id) AS holder FROM p WHERE n >= {MIN_DEDUP_BYTES} GROUP BY d HAVING count(*) > 1
), r AS (
  SELECT page_id, n, d, holder, coalesce(holder IS NOT NULL AND page_id IS DISTINCT FROM holder, false) AS rev,
    CASE WHEN u = '' THEN '' ELSE array_to_string(list_reverse(string_split(regexp_replace(lower(
      regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', ''), '.')), ',') || ')' ||
      regexp_replace(regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '#.*$', '') END AS urlkey
  FROM p LEFT JOIN h USING (d)
)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN rev THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN rev THEN holder END AS refers_to, urlkey,
  row_number() OVER (ORDER BY urlkey, page_id) - 1 AS position
FROM r
"""
