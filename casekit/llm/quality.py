"""Operator 6: document quality from a linear-chain CRF over lines.

A document is the chain of its lines.  Each line has features of its own
bytes and words and those of the lines before and after it; the CRF (two
states, good and bad, with learned transitions) is trained in numpy on a
bounded sample of labelled documents, every line carrying its document's
label.  Forward-backward gives each line's probability of being good; the
document's score is their mean, weighted by line length.

Defined results: a null or empty text is one empty line and is scored like any
other.  Empty lines take part in the chain with weight 0 (a text of empty
lines only: equal weights).  Null labels are not learned from; repeated labels
of a document are all used.  Without any label every score is 0.5.  All
lines of very long texts are scored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casekit.llm.common import SPACES, Words, prepare, sized, slices, stored, table

SLICE_BYTES = 2 << 20
# The training sample: labelled documents, and lines in a row of each.
SAMPLE_DOCS = 4000
SAMPLE_LINES = 60
EPOCHS = 30
BATCH_DOCS = 128
THRESHOLD = 0.3

# Byte classes whose share of a line is a feature.
_CLASSES = {
    "upper": [*range(ord("A"), ord("Z") + 1)],
    "digit": [*range(ord("0"), ord("9") + 1)],
    "space": list(SPACES),
    "stop": list(b".,;:'\"-"),
    "bar": list(b"|"),
    "shout": list(b"!?"),
    "symbol": list(b"#$%&*@^~<>{}[]()=+_\\/`"),
    "high": [*range(0x80, 0x100)],
}
N_OWN = len(_CLASSES) + 7


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line, its length, and the first line of each text.

    Returns (lines x 3 * N_OWN: own, previous, next; zeros past the ends).
    """
    raw = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", dtype=np.uint8)
    breaks = np.flatnonzero(raw == ord("\n"))
    lo, hi = breaks[:-1] + 1, breaks[1:]
    size = hi - lo
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(lo, bounds + 1)
    per_byte = 1.0 / np.maximum(size, 1)
    cols = []
    for members in _CLASSES.values():
        flag = np.zeros(256, dtype=np.int32)
        flag[members] = 1
        upto = np.concatenate([[0], np.cumsum(flag[raw])])
        cols.append((upto[hi] - upto[lo]) * per_byte)
    words = Words(texts, SPACES)  # laid out as raw is: same positions
    a, b = np.searchsorted(words.start, lo), np.searchsorted(words.start, hi)
    n_words = b - a
    per_word = 1.0 / np.maximum(n_words, 1)
    again = np.concatenate([[0, 0], np.cumsum(words.hash[1:] == words.hash[:-1])])[:len(words.hash) + 1]
    inside = np.maximum(again[b] - again[np.minimum(a + 1, len(words.hash))], 0)
    total = np.concatenate([[np.uint64(0)], np.cumsum(words.hash)])
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    mark = total[b] - total[a] + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, which, times = np.unique(mark, return_inverse=True, return_counts=True)
    cols += [
        np.log1p(size), np.log1p(n_words),
        np.minimum(size * per_word, 40) / 10,
        inside * per_word,
        (times[which] > 1) & (n_words > 0),
        n_words == 0,
        np.log1p(np.repeat(np.diff(first), np.diff(first))),
    ]
    own = np.stack([np.asarray(c, dtype=np.float64) for c in cols], axis=1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    starts = first[:-1][np.diff(first) > 0]
    before[starts] = 0
    after[first[1:][np.diff(first) > 0] - 1] = 0
    return np.concatenate([own, before, after], axis=1), size, first


class LineCRF:
    """Two-state linear chain: state 1 is a good line."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray) -> None:
        self.mean, self.scale = mean, scale
        self.weight = np.zeros(len(mean) + 1)
        self.transition = np.zeros((2, 2))

    def inputs(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.scale, -10, 10)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def marginals(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line, and expected transitions of all chains.

        All chains step together, longest first, so a step works on a prefix.
        """
        good = 1 / (1 + np.exp(-np.clip(x @ self.weight, -30, 30)))
        unary = np.stack([1 - good, good], axis=1)
        step = np.exp(self.transition)
        count = np.diff(first)
        by_length = np.argsort(-count, kind="stable")
        start, count = first[:-1][by_length], count[by_length]
        longest = int(count[0]) if len(count) else 0
        live = np.searchsorted(-count, -np.arange(longest), "left")
        forward, backward = unary.copy(), np.ones_like(unary)
        for t in range(1, longest):
            at = start[:live[t]] + t
            forward[at] = self._norm((forward[at - 1] @ step) * unary[at])
        expected = np.zeros((2, 2))
        for t in range(longest - 1, 0, -1):
            at = start[:live[t]] + t
            ahead = unary[at] * backward[at]
            pair = forward[at - 1][:, :, None] * step * ahead[:, None, :]
            expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            backward[at - 1] = self._norm(ahead @ step.T)
        return self._norm(forward * backward)[:, 1], expected

    @staticmethod
    def _norm(p: np.ndarray) -> np.ndarray:
        return p / np.maximum(p.sum(axis=1, keepdims=True), 1e-300)

    def fit(self, chains: list[np.ndarray], labels: np.ndarray, seed: int = 5,
            rate: float = 0.05, penalty: float = 1e-3) -> None:
        """Adam on the conditional log-likelihood per line."""
        rng = np.random.default_rng(seed)
        params = [self.weight, self.transition]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(chains))
            for lo in range(0, len(order), BATCH_DOCS):
                rows = order[lo:lo + BATCH_DOCS]
                x = self.inputs(np.concatenate([chains[i] for i in rows]))
                count = np.array([len(chains[i]) for i in rows])
                first = np.concatenate([[0], np.cumsum(count)])
                y = np.repeat(labels[rows], count)
                good, expected = self.marginals(x, first)
                seen = np.zeros((2, 2))
                np.add.at(seen, (labels[rows], labels[rows]), count - 1)
                grads = [x.T @ (y - good) / len(x) - penalty * self.weight,
                         (seen - expected) / len(x) - penalty * self.transition]
                step += 1
                for p, g, a, b in zip(params, grads, m, v):
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    p += rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)

    def lines(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) and length of every line, and each text's first line."""
        features, size, first = line_features(texts)
        return self.marginals(self.inputs(features), first)[0], size, first

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Length-weighted mean probability of a good line."""
        good, size, first = self.lines(texts)
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        whole = np.bincount(owner, size, len(texts))
        weight = np.where(whole[owner] > 0, size, 1.0)
        return np.bincount(owner, good * weight, len(texts)) / np.bincount(owner, weight, len(texts))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LineCRF | None:
    """Fit on a sample of about ``sample_docs`` labelled training documents.

    The sample is a share of the labels by hash of the id, one document and one
    label of each kind of a repeated id; of each document up
    to ``SAMPLE_LINES`` lines in a row from a hashed place are gathered, as
    numbers, so the driver's share is bounded however long the texts are.
    """
    usable = labels.where(
        "doc_id IS NOT NULL AND quality IN (0, 1) AND crc32(cast(doc_id as string)) % 5 <> 0")
    known = usable.count()
    if not known:
        return None
    share = min(1.0, sample_docs / known)
    ids = stored(usable.where(f"pmod(xxhash64(doc_id, 'quality'), 1000000) < {share} * 1000000")
                 .selectExpr("doc_id", "cast(quality as int) AS quality").distinct(), "quality-sample")
    picked = docs.join(sized(ids), "doc_id").selectExpr(
        "quality", "xxhash64(doc_id) AS h", "coalesce(cast(text as binary), binary('')) AS body")
    # One document an id, picked map-side: a hot id doesn't fill the sample.
    picked = picked.groupBy("quality", "h").agg(F.expr("min(struct(xxhash64(body) AS k, body)).body AS body"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("quality", "h", "body"))))
            for lo, hi in slices([len(r[2]) for r in rows], SLICE_BYTES):
                features, _, first = line_features([r[2] for r in rows[lo:hi]])
                for (quality, h, _), a, b in zip(rows[lo:hi], first[:-1], first[1:]):
                    a = a + h % max(1, b - a - SAMPLE_LINES + 1)
                    chain = features[a:min(b, a + SAMPLE_LINES)].astype("<f4")
                    out.append((quality, h, chain.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()),
                 pa.array([r[2] for r in out], pa.binary())], names=["quality", "h", "chain"])

    rows = picked.mapInArrow(gather, "quality int, h bigint, chain binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["h"], r["quality"]))
    chains = [np.frombuffer(r["chain"], "<f4").reshape(-1, 3 * N_OWN).astype(np.float64) for r in rows]
    every = np.concatenate(chains)
    model = LineCRF(every.mean(axis=0), every.std(axis=0) + 1e-6)
    model.fit(chains, np.array([r["quality"] for r in rows]))
    return model


def scorer(spark: SparkSession, model: LineCRF | None, text: Column) -> Column:
    """Column of document scores, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        crf = shared.value
        for batch in batches:
            texts = [t or b"" for t in batch.to_pylist()]
            if crf is None or not texts:
                yield pa.array([0.5] * len(texts), pa.float64())
                continue
            yield pa.array(np.concatenate(
                [crf.score(texts[lo:hi]) for lo, hi in
                 slices([len(t) + 1 for t in texts], SLICE_BYTES)]))

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, returnType="double")(text.cast("binary"))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Contract query: quality of every document."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", scorer(spark, model, F.col("text")).alias("score")).selectExpr(
        "doc_id", "coalesce(crc32(cast(doc_id as string)) % 5 = 0, false) AS held_out",
        "score", f"if(score >= {THRESHOLD}, 1, 0) AS predicted")
