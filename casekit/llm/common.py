"""Helpers the training-data operators share: table access, stored
intermediates and vectorised word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casekit.plans.pipeline import scratch_path

# Limits of an Arrow batch sent to Python: documents average a few kB but may
# hold megabytes, and rows of some stages are packs of many records, so a batch
# ends at either limit and memory follows the longest row.  One pair of limits
# for all stages: results are lazy, and a later query must not change how an
# unread one runs.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}

# ASCII white space as the contracts define it: 0x20 and 0x09-0x0D.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
# Separators of the alphanumeric word rule [^\x00-\x2F\x3A-\x60\x7B-\x7F]+,
# applied after A-Z became a-z.
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


# Rows of a side that may be broadcast once it has been counted.
BROADCAST_ROWS = 1_000_000


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the Python stages, the same for all (idempotent)."""
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def sized(small: DataFrame) -> DataFrame:
    """Mark a stored table of narrow rows for broadcast if its count allows.

    Above ``BROADCAST_ROWS`` the join is left to shuffle, with skew splitting.
    """
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts lineage so that a lost executor costs the lost tasks only, and gives
    later joins plain scans that adaptive execution can split when skewed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _splitmix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (in place on a uint64 array)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, key: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit numbers."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _splitmix(x + np.uint64(key)) | np.uint64(1)


_BYTE_CODE = seeds(256, 11)
_BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse mod 2**64
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


_CHUNK = 1 << 17  # bytes hashed at once: the work arrays stay in cache
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i < n."""
    size = max(n, _CHUNK)
    if size not in _powers:
        _powers.clear()
        pair = []
        for base in (_BASE, _INVERSE):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            pair.append(np.multiply.accumulate(x, out=x))
        _powers[size] = (pair[0], pair[1])
    return _powers[size]


class Words:
    """Words of many texts, hashed without a Python loop over words.

    ``buffer`` holds the lower-cased (A-Z only) bytes of all texts,
    ``start``/``end`` the byte bounds of each word, ``hash`` its 64-bit hash
    and ``first`` (length n_texts + 1) the index of each text's first word.
    """

    def __init__(self, texts: list[bytes], separators: bytes) -> None:
        lower = np.arange(256, dtype=np.uint8)
        lower[ord("A"):ord("Z") + 1] += 32
        is_sep = np.zeros(256, dtype=bool)
        is_sep[np.frombuffer(separators, dtype=np.uint8)] = True
        # Separators around every text, so no word spans two texts.
        sep = separators[:1]
        buf = lower[np.frombuffer(sep + sep.join(texts) + sep, dtype=np.uint8)]
        gap = is_sep[buf]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        self.buffer, self.start, self.end = buf, edge[0::2], edge[1::2]
        bounds = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)), out=bounds[1:])
        self.first = np.searchsorted(self.start, bounds)
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Polynomial hash of each word: its part of the chunk's prefix sums
        of code(byte) * base**position, moved back to position 0."""
        out = np.empty(len(self.start), dtype=np.uint64)
        lo = 0
        while lo < len(out):
            base = self.start[lo]
            hi = max(lo + 1, int(np.searchsorted(self.end, base + _CHUNK, "right")))
            part = self.buffer[base:self.end[hi - 1]]
            up, back = _power_table(len(part))
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODE[part] * up[:len(part)], out=total[1:])
            s, e = self.start[lo:hi] - base, self.end[lo:hi] - base
            out[lo:hi] = (total[e] - total[s]) * back[s] + (e - s).astype(np.uint64)
            lo = hi
        return _splitmix(out)

    def word(self, i: int) -> bytes:
        return self.buffer[self.start[i]:self.end[i]].tobytes()


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``limit``."""
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)
