"""Operator 4: token ids as fixed-stride shards in training order.

Every document becomes a token stream (its ids and one end id), cut into
sequences of ``seq_len`` ids.  A sequence's number is counted in file and row
order over what every document could need at most (a token is a byte or
more), so texts are tokenised only once.  A keyed Feistel permutation with
cycle-walking turns the numbers into places; the sequences in order of place
have the global slots 0..N-1.  Places are dealt by range: partition s holds
``shard_span`` of them and writes its sequences in order as records of one
fixed stride.  ``manifest`` has each shard's first slot, so a reader finds
slot k at ``(k - first) * stride`` of its shard and can stop and resume
anywhere.

A record is doc_id (int64), seq_no and n_tokens (int32), ``seq_len`` ids
(uint16, padded with the end id) and a newline, all little-endian.  Shards are
written by Spark's text writer (one line per record) and its committer, so a
lost task leaves nothing half-written.

Defined results: a null or empty text gives one sequence holding only the end
id.  A null doc_id is stored as the smallest int64 and read back as null.
Repeated rows are separate sequences.  An empty table gives no shards.  Extra
columns are ignored.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casekit.llm.common import prepare, sized, stored, table
from casekit.plans.pipeline import scratch_path

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_ID = 50256
SEQ_LEN = 256
SHARD_SPAN = 8192  # places of a shard
KEY = 0x5EED
NO_ID = -(1 << 63)
PACK_BYTES = 8 << 20  # a task's buffered records before they are sent
TASK_BYTES = 64 << 20  # records, at most, that a writing task sorts
CACHED_WORDS = 600_000
ODD_SPACE = re.compile(r"\s")


class Tokenizer(dict):
    """Byte-level BPE of whole texts, of many words at once, and of single words
    with a bounded cache.

    Values are little-endian uint16 ids as bytes.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding(
            "file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.after_space = np.zeros(END_ID + 1, dtype=bool)
        self.after_space[[i for token, i in ranks.items() if token.startswith(b" ")]] = True

    def ids(self, text: str) -> bytes:
        return struct.pack(f"<{len(n := self.bpe.encode_ordinary(text))}H", *n)

    def __missing__(self, word: str) -> bytes:
        out = self.ids(" " + word)
        if len(self) < CACHED_WORDS:  # frequent words come early and stay
            self[word] = out
        return out

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each written after one space, and how many each has.

        As each word on its own, but encoded at once: only words with white
        space of their own (not ASCII) could be cut otherwise, and are not.
        """
        words = text.split(" ")[1:]
        plain = np.array([w.isascii() or not ODD_SPACE.search(w) for w in words], dtype=bool)
        odd = [np.frombuffer(self.ids(" " + words[i]), "<u2") for i in np.flatnonzero(~plain).tolist()]
        if odd:
            text = "".join(" " + words[i] for i in np.flatnonzero(plain).tolist())
        ids = np.array(self.bpe.encode_ordinary(text), dtype="<u2")
        n = np.empty(len(words), dtype="<i4")
        n[plain] = np.diff(np.flatnonzero(self.after_space[ids]), append=len(ids))
        n[~plain] = [len(x) for x in odd]
        if odd:
            both, is_plain = np.empty(n.sum(), dtype="<u2"), np.repeat(plain, n)
            both[is_plain], both[~is_plain] = ids, np.concatenate(odd)
            ids = both
        return ids, n

    def encode(self, text: str) -> bytes:
        """A whole text at once: no word is kept, so a worker's memory does not
        follow the corpus' vocabulary (an eighth of sf0.1's words are distinct)."""
        return self.ids(text)


_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One tokenizer per worker process and file."""
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


class Feistel:
    """Keyed permutation of 0..n-1: a balanced Feistel network over the next
    even power of two, walked along its cycle until it falls below n."""

    ROUNDS = 4

    def __init__(self, n: int, key: int = KEY) -> None:
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xBF58476D1CE4E5B9) % (1 << 64))
                     for r in range(1, self.ROUNDS + 1)]

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in self.keys:
            left, right = right, left ^ (self._mix(right + k) & self.mask)
        return (left << self.half) | right

    def __call__(self, index: np.ndarray) -> np.ndarray:
        out = self._once(index.astype(np.uint64))
        away = np.flatnonzero(out >= self.n)
        while len(away):
            out[away] = self._once(out[away])
            away = away[out[away] >= self.n]
        return out.astype(np.int64)


def _scan(docs: DataFrame) -> DataFrame:
    """(doc_id, body, f, r): documents with their file and row number there.

    ``docs`` must be a file scan; its rows then have a lasting identity that
    both passes agree on, whatever tasks they run in.
    """
    return docs.selectExpr(
        "cast(doc_id as bigint) AS doc_id", "coalesce(cast(text as string), '') AS body",
        "xxhash64(_metadata.file_path) AS f", "_metadata.row_index AS r")


def _binary(data: bytes, sizes: np.ndarray) -> pa.Array:
    """Binary values of the given sizes that lie one after another."""
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def numbering(docs: DataFrame, seq_len: int = SEQ_LEN) -> tuple[DataFrame, int]:
    """((f, r, start) with the first number of each row, and how many there are).

    Running totals go over blocks of 4096 rows, then inside each block.
    """
    counts = stored(_scan(docs).selectExpr(
        "f", "r", "r div 4096 AS b", f"octet_length(body) div {seq_len} + 1 AS s"), "token-bounds")
    blocks = counts.groupBy("f", "b").agg(F.sum("s").alias("s"))
    blocks = stored(blocks.selectExpr(
        "f", "b", "s", "sum(s) OVER (ORDER BY f, b) - s AS base"), "token-blocks")
    total = blocks.agg(F.max(F.expr("base + s"))).first()[0] or 0
    inside = counts.selectExpr(
        "f", "r", "b", "sum(s) OVER (PARTITION BY f, b ORDER BY r) - s AS before")
    starts = inside.join(sized(blocks), ["f", "b"]).selectExpr("f", "r", "base + before AS start")
    return stored(starts, "token-starts"), total


def write_shards(docs: DataFrame, out: str, path: str = TOKENIZER, seq_len: int = SEQ_LEN,
                 shard_span: int = SHARD_SPAN, key: int = KEY) -> bool:
    """Write all sequences under ``out``; false if there are none."""
    starts, total = numbering(docs, seq_len)
    if not total:
        return False
    order = Feistel(total, key)
    size = 16 + 2 * seq_len
    end = np.array([END_ID], dtype="<u2").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records by shard, compressed: fewer and smaller rows to shuffle."""
        encode, codec = tokenizer(path).encode, pa.Codec("zstd", compression_level=1)
        held: list[bytes] = []
        index: list[np.ndarray] = []
        weight = 0

        def flush() -> pa.RecordBatch:
            places = order(np.concatenate(index))
            record = np.frombuffer(b"".join(held), dtype=np.uint8).reshape(-1, size)
            by_place = np.argsort(places, kind="stable")
            places, record = places[by_place], record[by_place]
            shards = places // shard_span
            cut = np.flatnonzero(np.diff(shards, prepend=-1))
            bodies, sizes = [], []
            for a, b in zip(cut, [*cut[1:], len(places)]):
                raw = places[a:b].tobytes() + record[a:b].tobytes()
                sizes.append(len(raw))
                bodies.append(codec.compress(raw, asbytes=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(shards[cut], pa.int32()), pa.array(sizes, pa.int32()),
                 pa.array(bodies, pa.binary())], names=["shard", "raw", "body"])

        for batch in batches:
            for doc, text, start in zip(*(batch.column(c).to_pylist()
                                          for c in ("doc_id", "body", "start"))):
                ids = encode(text) + end
                n_tokens = len(ids) // 2
                n = -(-n_tokens // seq_len)
                record = np.empty((n, size), dtype=np.uint8)
                record[:, :8] = np.frombuffer(
                    (NO_ID if doc is None else doc).to_bytes(8, "little", signed=True), np.uint8)
                record[:, 8:12] = np.arange(n, dtype="<i4").view(np.uint8).reshape(n, 4)
                used = np.full(n, seq_len, dtype="<i4")
                used[-1] = n_tokens - (n - 1) * seq_len
                record[:, 12:16] = used.view(np.uint8).reshape(n, 4)
                record[:, 16:] = np.frombuffer(
                    ids + end * (n * seq_len - n_tokens), np.uint8).reshape(n, 2 * seq_len)
                held.append(record.tobytes())
                index.append(np.arange(start, start + n))
                weight += n * size
                if weight >= PACK_BYTES:
                    yield flush()
                    held, index, weight = [], [], 0
        if held:
            yield flush()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            for shard, raw, body in zip(*(batch.column(c).to_pylist()
                                          for c in ("shard", "raw", "body"))):
                data = codec.decompress(body, decompressed_size=raw, asbytes=True)
                n = raw // (8 + size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, shard, np.int32)),
                     pa.array(np.frombuffer(data[:8 * n], dtype=np.int64)),
                     _binary(data[8 * n:], np.full(n, size))], names=["shard", "place", "record"])

    # A task writes neighbouring shards, so tasks grow with bytes, not shards.
    per_task = max(1, TASK_BYTES // (shard_span * size))
    tasks = -(-total // (shard_span * per_task))
    (
        _scan(docs).join(sized(starts), ["f", "r"]).select("doc_id", "body", "start")
        .mapInArrow(pack, "shard int, raw int, body binary")
        .repartitionById(tasks, F.expr(f"cast(shard div {per_task} as int)"))
        .mapInArrow(unpack, "shard int, place bigint, record binary")
        .sortWithinPartitions("shard", "place")
        .selectExpr("shard", "cast(record as string) AS value")
        .write.partitionBy("shard").option("lineSep", "\n").text(out)
    )
    return True


def manifest(spark: SparkSession, path: str, seq_len: int = SEQ_LEN) -> DataFrame:
    """(shard, first, n): the first slot and number of sequences of each shard.

    Read from the files' lengths: one row per shard, none of their contents.
    """
    files = spark.read.format("binaryFile").load(path)
    sizes = files.groupBy("shard").agg((F.sum("length") / (17 + 2 * seq_len)).cast("bigint").alias("n"))
    return sizes.selectExpr("shard", "sum(n) OVER (ORDER BY shard) - n AS first", "n")


def read_slots(spark: SparkSession, path: str, first: int = 0, last: int | None = None,
               seq_len: int = SEQ_LEN) -> DataFrame:
    """(slot, shard, doc_id, seq_no, n_tokens, ids binary) for slots first..last-1.

    Only the shards that hold the range are opened; ``first`` is where an
    interrupted reader resumes.
    """
    size, stride = 16 + 2 * seq_len, 17 + 2 * seq_len
    schema = "slot bigint, shard int, doc_id bigint, seq_no int, n_tokens int, ids binary"
    wanted = manifest(spark, path, seq_len).where(f"first + n > {first}")
    if last is not None:
        wanted = wanted.where(f"first < {last}")
    wanted = stored(wanted.select("shard", "first"), "token-manifest")
    files = (
        spark.read.format("binaryFile").load(path).select("shard", "content")
        .join(sized(wanted), "shard").select("shard", "first", "content"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start, content in zip(batch.column("shard").to_pylist(), batch.column("first").to_pylist(),
                                             batch.column("content")):
                data = np.frombuffer(content.as_buffer(), dtype=np.uint8).reshape(-1, stride)
                slot = np.arange(len(data), dtype=np.int64) + start
                keep = slot >= first if last is None else (slot >= first) & (slot < last)
                data, slot = data[keep], slot[keep]
                doc = np.ascontiguousarray(data[:, :8]).view("<i8").ravel()
                seq = np.ascontiguousarray(data[:, 8:12]).view("<i4").ravel()
                used = np.ascontiguousarray(data[:, 12:16]).view("<i4").ravel()
                filled = np.arange(2 * seq_len) < 2 * used[:, None]
                ids = data[:, 16:size][filled].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(np.full(len(slot), shard, np.int32)),
                     pa.array(doc, mask=doc == NO_ID), pa.array(seq), pa.array(used),
                     _binary(ids, 2 * used)],
                    names=["slot", "shard", "doc_id", "seq_no", "n_tokens", "ids"])

    return files.mapInArrow(cut, schema)


def materialise(docs: DataFrame, path: str = TOKENIZER, seq_len: int = SEQ_LEN,
                shard_span: int = SHARD_SPAN, key: int = KEY) -> DataFrame:
    """Write the shards to the shared folder and read every slot back:
    (slot, shard, doc_id, seq_no, n_tokens, ids_sha256)."""
    spark = docs.sparkSession
    prepare(spark)
    out = scratch_path(spark, "token-shards")
    if not write_shards(docs, out, path, seq_len, shard_span, key):
        return spark.createDataFrame(
            [], "slot bigint, shard int, doc_id bigint, seq_no int, n_tokens int, ids_sha256 string")
    return read_slots(spark, out, 0, None, seq_len).selectExpr(
        "slot", "shard", "doc_id", "seq_no", "n_tokens", "sha2(ids, 256) AS ids_sha256")


def op4_token_shards(spark, sf_dir: str) -> DataFrame:
    """All documents as shards in training order, read back slot by slot."""
    return materialise(table(spark, sf_dir, "documents"))
