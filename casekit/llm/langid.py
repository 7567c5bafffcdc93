"""Operator 8: language identification with a byte convolutional network.

Every text is cut into fixed-length windows of bytes.  Filters of widths 2, 3
and 4 slide over learned byte embeddings, each filter keeps its maximum over
the window, and a softmax over the pooled maxima gives the window's language;
a text's language is the softmax of its windows' mean log probabilities,
weighted by their bytes.  The network is trained in numpy on a bounded sample
of labelled windows.

When applied, embedding and filters are folded into one table per byte pair,
so a position costs three table rows whatever the widths.

Defined results: a null text or one without a letter is ``und`` with score 0,
as is every text when no labelled text exists.  Invalid or very long texts
need nothing special: all bytes are read, in bounded slices.  Null labels are
not learned from.  Repeated rows get equal results.  An empty table gives an
empty result.  Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casekit.llm.common import prepare, sized, stored, table

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBED = 8
# The training sample: documents per language, and windows of each document.
SAMPLE_DOCS = 300
SAMPLE_TOTAL = 6000
SAMPLE_WINDOWS = 6
EPOCHS = 12
BATCH_WINDOWS = 64
UNKNOWN = "und"
MIN_SCORE = 0.5  # the pipeline rejects documents below it


def windows(text: bytes, size: int = WINDOW) -> np.ndarray:
    """(n, size) bytes of the whole text, the last window filled with zeros."""
    n = max(1, -(-len(text) // size))
    out = np.zeros(n * size, dtype=np.uint8)
    out[:len(text)] = np.frombuffer(text, dtype=np.uint8)
    return out.reshape(n, size)


class ByteCNN:
    """Multi-width convolution over byte embeddings, max pooling, softmax."""

    def __init__(self, languages: list[str], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.embed = rng.normal(0, 1, (256, EMBED)).astype(np.float32)
        self.kernels = [rng.normal(0, (w * EMBED) ** -0.5, (w, EMBED, FILTERS)).astype(np.float32)
                        for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), dtype=np.float32)
        self.out = np.zeros((FILTERS * len(WIDTHS), len(languages)), dtype=np.float32)
        self.out_bias = np.zeros(len(languages), dtype=np.float32)

    def fold(self) -> None:
        """Tables by byte (pair) that replace embedding and filters."""
        t = [[self.embed @ k[i] for i in range(len(k))] for k in self.kernels]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        self.at_0 = np.concatenate([pair(*t[0]), pair(*t[1][:2]), pair(*t[2][:2])], axis=1)
        self.at_0 += self.bias
        self.at_2 = np.concatenate([np.repeat(t[1][2], 256, axis=0), pair(*t[2][2:])], axis=1)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Responses at every position (all widths start together) and their maxima."""
        n, size = x.shape
        code = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        steps = size - max(WIDTHS) + 1
        r = self.at_0[code[:, :steps].ravel()]
        r[:, FILTERS:] += self.at_2[code[:, 2:2 + steps].ravel()]
        r = r.reshape(n, steps, -1)
        return r, r.max(axis=1)

    def log_probs(self, features: np.ndarray) -> np.ndarray:
        z = np.maximum(features, 0) @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 7, rate: float = 0.01) -> None:
        """Adam on the cross entropy; gradients flow to each filter's best position."""
        rng = np.random.default_rng(seed)
        params = [self.embed, *self.kernels, self.bias, self.out, self.out_bias]
        m = [np.zeros_like(p) for p in params]
        v = [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for lo in range(0, len(order), BATCH_WINDOWS):
                rows = order[lo:lo + BATCH_WINDOWS]
                grads = self._gradients(x[rows], y[rows])
                step += 1
                for p, g, a, b in zip(params, grads, m, v):
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)
        self.fold()

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        n = len(x)
        self.fold()
        response, best = self.pooled(x)
        at = response.argmax(axis=1)
        active = np.maximum(best, 0)
        g = np.exp(self.log_probs(best))
        g[np.arange(n), y] -= 1
        g /= n
        g_best = (g @ self.out.T) * (best > 0)
        d_embed = np.zeros_like(self.embed)
        d_kernels = []
        row = np.arange(n)[:, None]
        for j, kernel in enumerate(self.kernels):
            part = slice(j * FILTERS, (j + 1) * FILTERS)
            gp, pos = g_best[:, part], at[:, part]
            d_kernel = np.empty_like(kernel)
            for i in range(len(kernel)):
                byte = x[row, pos + i]
                d_kernel[i] = np.einsum("nf,nfe->ef", gp, self.embed[byte])
                np.add.at(d_embed, byte, gp[:, :, None] * kernel[i].T[None])
            d_kernels.append(d_kernel)
        return [d_embed, *d_kernels, g_best.sum(axis=0), active.T @ g, g.sum(axis=0)]

    def classify(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(language number, probability) of each text, over all its windows."""
        counts = [max(1, -(-len(t) // WINDOW)) for t in texts]
        total = np.zeros((len(texts), len(self.languages)))
        owner = np.repeat(np.arange(len(texts)), counts)
        filled = np.zeros((sum(counts), WINDOW), dtype=np.uint8)
        row = 0
        weight = np.empty(len(filled))
        for t, n in zip(texts, counts):
            filled[row:row + n].reshape(-1)[:len(t)] = np.frombuffer(t, dtype=np.uint8)
            weight[row:row + n] = WINDOW
            weight[row + n - 1] = len(t) - (n - 1) * WINDOW
            row += n
        for lo in range(0, len(filled), BATCH_WINDOWS):
            part = slice(lo, lo + BATCH_WINDOWS)
            lp = self.log_probs(self.pooled(filled[part])[1])
            np.add.at(total, owner[part], lp * weight[part, None])
        total /= np.maximum(1, np.array([len(t) for t in texts]))[:, None]
        total -= total.max(axis=1, keepdims=True)
        p = np.exp(total)
        p /= p.sum(axis=1, keepdims=True)
        return p.argmax(axis=1), p.max(axis=1)


def training_windows(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages and a bounded sample of labelled windows.

    About ``SAMPLE_DOCS`` documents of each language (fewer when there are
    very many languages), taken by hash of the id at a rate set from the
    language's count, one document of a repeated id; of each, windows at hashed
    places over its whole length.
    """
    labelled = docs.where(
        "lang IS NOT NULL AND text IS NOT NULL AND crc32(cast(doc_id as string)) % 5 <> 0")
    counts = stored(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang-counts")
    known = counts.count()
    if not known:
        return [], np.empty((0, WINDOW), np.uint8), np.empty(0, np.int64)
    each = max(10, min(SAMPLE_DOCS, SAMPLE_TOTAL // known))
    rates = counts.selectExpr("lang", f"{each} / n AS __rate")
    picked = (
        labelled.join(sized(rates), "lang")
        .where("pmod(xxhash64(doc_id, 'lang'), 1000000) < __rate * 1000000")
        .selectExpr("lang", "cast(text as binary) AS body", "xxhash64(doc_id) AS h")
        # One document an id, picked map-side: a hot id doesn't fill the sample.
        .groupBy("lang", "h").agg(F.expr("min(struct(xxhash64(body) AS k, body)).body AS body")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, hashes, bodies = [], [], []
            for lang, body, h in zip(*(batch.column(c).to_pylist() for c in ("lang", "body", "h"))):
                w = windows(body)
                rng = np.random.default_rng(h & 0xFFFFFFFF)
                for i in rng.permutation(len(w))[:SAMPLE_WINDOWS]:
                    langs.append(lang)
                    hashes.append(h)
                    bodies.append(w[i].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(hashes, pa.int64()),
                 pa.array(bodies, pa.binary())], names=["lang", "h", "w"])

    rows = picked.mapInArrow(cut, "lang string, h bigint, w binary").collect()
    rows.sort(key=lambda r: (r["h"], r["lang"], bytes(r["w"])))
    languages = sorted({r["lang"] for r in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    x = np.array([np.frombuffer(r["w"], np.uint8) for r in rows]).reshape(-1, WINDOW)
    return languages, x, np.array([number[r["lang"]] for r in rows], dtype=np.int64)


def train(docs: DataFrame) -> ByteCNN | None:
    languages, x, y = training_windows(docs)
    if not languages:
        return None
    model = ByteCNN(languages)
    model.fit(x, y)
    del model.at_0, model.at_2  # folded again by each worker: smaller to send
    return model


def predictor(spark: SparkSession, model: ByteCNN | None) -> Callable[[Column], Column]:
    """Column function text -> struct(lang, score)."""
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cnn = shared.value
        if cnn is not None:
            cnn.fold()
        for batch in batches:
            texts = [t or b"" for t in batch.to_pylist()]
            if cnn is None:
                lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            else:
                best, score = cnn.classify(texts)
                lang = [cnn.languages[i] for i in best.tolist()]
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["lang", "score"])

    predict.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(predict, returnType="struct<lang:string,score:double>")

    def column(text: Column) -> Column:
        has_letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
        none = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
        return F.when(has_letter, udf(text.cast("binary"))).otherwise(none)

    return column


def keep_identified(docs: DataFrame, model: ByteCNN | None = None,
                    min_score: float = MIN_SCORE) -> DataFrame:
    """Documents whose language is recognised, with their own columns only."""
    model = model or train(docs)
    column = predictor(docs.sparkSession, model)
    return (
        docs.withColumn("__lang", column(F.col("`text`")))
        .where(f"__lang.lang <> '{UNKNOWN}' AND __lang.score >= {min_score}")
        .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract query: the language of every document."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    column = predictor(spark, train(docs))
    return docs.select("doc_id", column(F.col("text")).alias("p")).selectExpr(
        "doc_id", "coalesce(crc32(cast(doc_id as string)) % 5 = 0, false) AS held_out",
        "p.lang AS lang_pred", "p.score AS score")
