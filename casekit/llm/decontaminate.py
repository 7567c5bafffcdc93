"""Operator 1: benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are the word windows of the benchmark items; the text is a sequence
of word hashes.  Per pattern length m a shift table says, for the two-word
block at the end of the current window, how far the window may move before
any pattern can match; only where the shift is 0 does the block's bucket of
pattern suffixes select test strings, and those are compared word by word.
Many short segments of many texts advance together, one numpy step for all.

Items are cut into overlapping pieces, and the pieces dealt into blocks of
bounded size whose tables are built in tasks and stored.  The documents are
searched for one block after another: the driver and a worker hold the tables
of one block, never the benchmark.  Hits of several blocks are merged per
document row.

Defined results: a null or empty text has no words and no hits.  Items whose
text or id is null, or that have no words, have no windows.  Items sharing an
id are one item, however many rows it has.  Windows shared by several items count for all of them.
Repeated document rows give repeated results.  Empty tables on either side
give no hits or no rows.  Other columns pass through untouched.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casekit.llm.common import NON_ALNUM, Words, prepare, slices, stored, table
from casekit.plans.pipeline import scratch_path

WINDOW = 13
BLOCK_BYTES = 4 << 20  # benchmark text per block of tables
PIECE_WINDOWS = 2048  # windows of a piece of an item
SLICE_BYTES = 2 << 20  # document text hashed at once
SEGMENT = 128  # window positions a cursor walks
SHIFT_BITS = 18

_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Tables:
    """Shift table and suffix buckets for all patterns of one length.

    ``words`` are the block's words, shared by all lengths; a pattern is the
    place of its first word there.
    """

    def __init__(self, words: Words, starts: np.ndarray, item: np.ndarray, length: int) -> None:
        self.words, self.length, self.block = words, length, min(2, length)
        grid = words.hash[starts[:, None] + np.arange(length)]
        # One pattern per distinct window; its owners are the items it occurs in.
        _, keep, pattern = np.unique(grid, axis=0, return_index=True, return_inverse=True)
        grid, self.starts = grid[keep], starts[keep]
        pairs = np.unique(np.stack([pattern.reshape(-1), item], axis=1), axis=0)
        self.owner = pairs[:, 1].astype(np.int32)
        self.owner_start = np.searchsorted(pairs[:, 0], np.arange(len(keep) + 1))
        self.shift = np.full(1 << SHIFT_BITS, length - self.block + 1, dtype=np.int32)
        for end in range(self.block, length + 1):
            np.minimum.at(self.shift, self._slot(grid, end), length - end)
        suffix = self._slot(grid, length)
        self.bucket = np.argsort(suffix, kind="stable")
        self.bucket_start = np.searchsorted(
            suffix[self.bucket], np.arange((1 << SHIFT_BITS) + 1)).astype(np.int32)

    def _slot(self, grid: np.ndarray, end: int) -> np.ndarray:
        return self._hash(grid[:, end - self.block], grid[:, end - 1])

    @staticmethod
    def _hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (((a * _MIX) ^ b) * _MIX >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(window position, pattern) of every occurrence."""
        m, h, own = self.length, words.hash, self.words.hash
        counts = np.maximum(words.first[1:] - words.first[:-1] - m + 1, 0)
        parts = -(-counts // SEGMENT)
        part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        pos = np.repeat(words.first[:-1], parts) + part * SEGMENT
        stop = np.minimum(pos + SEGMENT, np.repeat(words.first[:-1] + counts, parts))
        found_pos, found_pattern = [], []
        while len(pos):
            slot = self._hash(h[pos + m - self.block], h[pos + m - 1])
            shift = self.shift[slot]
            test = np.flatnonzero(shift == 0)
            if len(test):
                lo = self.bucket_start[slot[test]].astype(np.int64)
                n = self.bucket_start[slot[test] + 1] - lo
                at = np.repeat(pos[test], n)
                order = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                pattern = self.bucket[order]
                same = h[at] == own[self.starts[pattern]]
                at, pattern = at[same], pattern[same]
                same = (h[at[:, None] + np.arange(m)]
                        == own[self.starts[pattern][:, None] + np.arange(m)]).all(axis=1)
                found_pos.append(at[same])
                found_pattern.append(pattern[same])
            pos = pos + np.maximum(shift, 1)
            live = pos < stop
            pos, stop = pos[live], stop[live]
        if not found_pos:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at, pattern = np.concatenate(found_pos), np.concatenate(found_pattern)
        sure = [all(words.word(p + i) == self.words.word(q + i) for i in range(m))
                for p, q in zip(at.tolist(), self.starts[pattern].tolist())]
        return at[sure], pattern[sure]


class Matcher:
    """Searches texts for all windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW) -> None:
        self.items = [item for item, _ in items]
        words = Words([t for _, t in items], NON_ALNUM)
        n_words = np.diff(words.first)
        self.tables = []
        for length in np.unique(np.minimum(n_words[n_words > 0], window)).tolist():
            which = np.flatnonzero(np.minimum(n_words, window) == length)
            count = n_words[which] - length + 1
            inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            self.tables.append(_Tables(
                words, np.repeat(words.first[which], count) + inside, np.repeat(which, count), length))

    def search(self, texts: list[bytes]) -> list[dict]:
        """Per text: word count, merged hit spans (in words), items hit."""
        words = Words(texts, NON_ALNUM)
        out = [{"n_words": n, "spans": [], "items": set()}
               for n in (words.first[1:] - words.first[:-1]).tolist()]
        for found in self.tables:
            at, pattern = found.find(words)
            text = np.searchsorted(words.first, at, "right") - 1
            inside = at - words.first[text]
            for t, p, w in zip(text.tolist(), inside.tolist(), pattern.tolist()):
                out[t]["spans"].append((p, p + found.length))
                owners = found.owner[found.owner_start[w]:found.owner_start[w + 1]]
                out[t]["items"].update(self.items[i] for i in owners.tolist())
        for row in out:
            row["spans"] = [{"lo": a, "hi": b} for a, b in _union(row["spans"])]
            row["items"] = sorted(row["items"])
        return out


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


_RESULT = "struct<n_words:bigint,spans:array<struct<lo:bigint,hi:bigint>>,items:array<string>>"
_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
    ("items", pa.list_(pa.string()))])


def _searcher(shared) -> Callable:
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = shared.value
        for batch in batches:
            texts = [t or b"" for t in batch.to_pylist()]
            rows: list[dict] = []
            for lo, hi in slices([len(t) for t in texts], SLICE_BYTES):
                rows += matcher.search(texts[lo:hi])
            yield pa.array(rows, type=_ARROW)

    search.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(search, returnType=_RESULT)


def _pieces(window: int) -> Callable:
    """Function on (id, body): the item's words in pieces of PIECE_WINDOWS
    windows; neighbours overlap so that every window lies in one piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, body in zip(batch.column("id").to_pylist(), batch.column("body").to_pylist()):
                words = Words([body], NON_ALNUM)
                n = len(words.start)
                if n:
                    last = max(1, n - window + 1)
                    pieces = [b" ".join(words.word(i) for i in range(s, min(n, s + PIECE_WINDOWS + window - 1)))
                              for s in range(0, last, PIECE_WINDOWS)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(pieces)), pa.array(pieces, pa.binary())], names=["id", "body"])

    return cut


def benchmark_tables(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                     window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Stored (block, matcher): the search tables of every block, built in tasks.

    Pieces are dealt by id and text, so blocks stay near ``block_bytes`` even
    if one item is long or one id has a third of all rows.
    """
    items = benchmark.selectExpr(
        f"cast(`{id_col}` as string) AS id", f"cast(`{text_col}` as binary) AS body"
    ).where("id IS NOT NULL AND body IS NOT NULL")
    pieces = stored(items.mapInArrow(_pieces(window), "id string, body binary").distinct(),
                    "benchmark-pieces")
    total = pieces.agg(F.sum(F.octet_length("body")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_bytes))

    def build(group: pa.Table) -> pa.Table:
        items = sorted(zip(group.column("id").to_pylist(), group.column("body").to_pylist()))
        return pa.table({"block": group.column("block")[:1],
                         "matcher": pa.array([pickle.dumps(Matcher(items, window))], pa.binary())})

    dealt = pieces.withColumn("block", F.expr(f"cast(pmod(xxhash64(id, body), {blocks}) as int)"))
    return stored(dealt.groupBy("block").applyInArrow(build, "block int, matcher binary"),
                  "benchmark-tables")


def _matchers(tables: DataFrame) -> Iterator[Matcher]:
    """The blocks' matchers, one at a time; an empty one if there is no block."""
    numbers = sorted(r["block"] for r in tables.select("block").collect())  # one number a block
    if not numbers:
        yield Matcher([])
    for b in numbers:
        yield pickle.loads(tables.where(F.col("block") == b).first()["matcher"])


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                     window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[Matcher]:
    """Matchers of the benchmark's blocks, one at a time."""
    return _matchers(benchmark_tables(benchmark, id_col, text_col, window, block_bytes))


def _merged(n_words: Column, spans: Column, items: Column) -> Column:
    """Struct (n_words, spans, items, n_hit) of a row's hits in any order."""
    spans = F.array_sort(spans)
    n_hit = F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"),
                                   s["hi"] - F.greatest(s["lo"], acc["end"]))).alias("n"),
            F.greatest(acc["end"], s["hi"]).alias("end")),
        lambda acc: acc["n"])
    return F.struct(n_words.alias("n_words"), spans.alias("spans"),
                    F.array_sort(F.array_distinct(items)).alias("items"), n_hit.alias("n_hit"))


def hits(spark: SparkSession, benchmark: DataFrame, text: Column, window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES) -> Column:
    """Struct column (n_words, spans, items, n_hit) of a text column.

    ``spans`` are the word ranges inside occurrences of item windows, in order;
    those found by one block are merged, those of different blocks may overlap
    (``n_hit`` counts a word once).  One projection searches all blocks at once, so this form is for a
    benchmark of a few blocks; ``with_hits`` takes one of any size.
    """
    parts = [_searcher(spark.sparkContext.broadcast(m))(text.cast("binary"))
             for m in benchmark_blocks(benchmark, window=window, block_bytes=block_bytes)]
    return _merged(parts[0]["n_words"], F.flatten(F.array(*[p["spans"] for p in parts])),
                   F.flatten(F.array(*[p["items"] for p in parts])))


def with_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc, h): every row of ``docs`` as a struct, and its hits as ``hits`` gives them.

    A benchmark of one block is one narrow pass.  For more, the rows get a
    number and are stored; each block is a pass that stores the rows it hits
    (the first one all rows), and a row's parts are merged by its number.
    """
    spark = docs.sparkSession
    tables = benchmark_tables(benchmark, window=window, block_bytes=block_bytes)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.col(f"`{text_col}`").cast("binary").alias("body"))
    several = tables.count() > 1
    if several:
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows")
    out = scratch_path(spark, "decontaminate-hits")
    for b, matcher in enumerate(_matchers(tables)):
        shared = spark.sparkContext.broadcast(matcher)
        h = _searcher(shared)(F.col("body"))
        if not several:
            part = rows.select("doc", h.alias("p"))
            return part.select("doc", _merged(*[part["p"][c] for c in ("n_words", "spans", "items")]).alias("h"))
        found = rows.select("row", h.alias("p")).where(F.lit(b == 0) | (F.size("p.items") > 0))
        found.select("row", "p.*").write.parquet(f"{out}/block={b}")
        shared.destroy()
    # One row per block that hits it, so a group is as large as its document's hits.
    found = spark.read.parquet(out).groupBy("row").agg(
        _merged(F.max("n_words"), F.flatten(F.collect_list("spans")),
                F.flatten(F.collect_list("items"))).alias("h"))
    return rows.join(found, "row").select("doc", "h")


CONTAMINATED = "{h}.n_hit > 0 AND 20 * {h}.n_hit >= {h}.n_words"


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows."""
    found = with_hits(docs, benchmark, text_col)
    return (
        found.where(f"NOT ({CONTAMINATED.format(h='h')})")
        .select(*[F.col("doc").getField(c).alias(c) for c in docs.columns]))


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Contract query: contamination of every document."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_hits(docs, table(spark, sf_dir, "benchmark")).selectExpr(
        "doc.doc_id AS doc_id", "h.n_words AS n_words", "h.n_hit AS n_hit",
        "cast(size(h.items) as bigint) AS n_items",
        "sha2(array_join(h.items, ','), 256) AS items_sha256",
        f"{CONTAMINATED.format(h='h')} AS contaminated")


_LOWER = "translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH i AS (SELECT item_id, {_WORDS.format(c="text")} AS w FROM benchmark
  WHERE item_id IS NOT NULL AND text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS l,
    array_to_string(w[p:p + least({WINDOW}, len(w)) - 1], ' ') AS win
  FROM i, unnest(generate_series(1, len(w) - least({WINDOW}, len(w)) + 1)) AS t(p) WHERE len(w) > 0),
d AS (SELECT doc_id, {_WORDS.format(c="coalesce(text, '')")} AS w FROM documents),
dw AS (SELECT doc_id, l, p, array_to_string(w[p:p + l - 1], ' ') AS win
  FROM d, (SELECT DISTINCT l FROM iw) AS ls, unnest(generate_series(1, len(w) - l + 1)) AS t(p)),
hit AS (SELECT doc_id, l, p, item_id FROM dw JOIN iw USING (l, win)),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM hit, unnest(generate_series(p, p + l - 1)) AS t(q) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""
