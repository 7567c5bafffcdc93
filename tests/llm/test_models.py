"""Language ID and quality: the maths, and held-out accuracy."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from casekit.llm import langid, quality
from tests.llm import tables

SF = "/root/testdata/sf0.01"


def test_folded_tables_equal_the_convolution():
    cnn = langid.ByteCNN(["a", "b"])
    cnn.bias += 0.3
    cnn.fold()
    x = np.random.default_rng(1).integers(0, 256, (2, langid.WINDOW)).astype(np.uint8)
    _, best = cnn.pooled(x)
    steps = langid.WINDOW - max(langid.WIDTHS) + 1
    want = []
    for kernel in cnn.kernels:
        w = len(kernel)
        e = cnn.embed[x]
        r = np.stack([sum(e[:, t + i] @ kernel[i] for i in range(w)) for t in range(steps)], axis=1)
        want.append(r.max(axis=1))
    assert np.allclose(best, np.concatenate(want, axis=1) + 0.3, atol=1e-4)


def test_gradient_of_the_network():
    rng = np.random.default_rng(2)
    cnn = langid.ByteCNN(["a", "b", "c"])
    cnn.out += rng.normal(0, 0.5, cnn.out.shape).astype(np.float32)
    x = rng.integers(0, 256, (4, langid.WINDOW)).astype(np.uint8)
    y = np.array([0, 1, 2, 1])
    grads = cnn._gradients(x, y)
    params = [cnn.embed, *cnn.kernels, cnn.bias, cnn.out, cnn.out_bias]

    def loss() -> float:
        cnn.fold()
        return -cnn.log_probs(cnn.pooled(x)[1])[np.arange(4), y].mean()

    for p, g in zip(params, grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, eps = p[at], 1e-2
        p[at] = keep + eps
        up = loss()
        p[at] = keep - eps
        down = loss()
        p[at] = keep
        assert abs((up - down) / (2 * eps) - g[at]) < 0.05 * max(0.02, abs(g[at]))


def test_windows_hold_every_byte():
    for n in (0, 1, 255, 256, 257, 1000):
        text = bytes(range(1, 252)) * 4
        assert langid.windows(text[:n]).tobytes().rstrip(b"\0") == text[:n]


def test_held_out_languages(spark):
    got = entry.queries()["op8_language_id"](spark, SF).toPandas()
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    held = got[got.held_out].merge(truth, on="doc_id")
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_texts_without_letters_are_unknown(spark, awkward):
    got = entry.queries()["op8_language_id"](spark, awkward).toPandas()
    for d in tables.documents():
        if d["doc_id"] is not None and d["doc_id"] != 20:
            row = got[got.doc_id == d["doc_id"]].iloc[0]
            assert (row.lang_pred == "und") == (not d["text"] or not any(c.isalpha() for c in d["text"]))


def test_no_labels_is_no_model(spark, tmp_path):
    docs = [{"doc_id": i, "text": "some words here", "lang": None, "source": "s"} for i in range(5)]
    sf = tables.write(tmp_path, docs)
    assert {r.lang_pred for r in entry.queries()["op8_language_id"](spark, sf).collect()} == {"und"}
    assert {r.score for r in entry.queries()["op6_quality"](spark, sf).collect()} == {0.5}


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(6)
    crf = quality.LineCRF(np.zeros(3), np.ones(3))
    crf.weight[:] = rng.normal(size=4)
    crf.transition[:] = rng.normal(size=(2, 2))
    lengths = [1, 4, 2, 6]
    x = rng.normal(size=(sum(lengths), 4))
    first = np.concatenate([[0], np.cumsum(lengths)])
    got, expected = crf.marginals(x, first)
    want, pairs = np.zeros(len(x)), np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        s = x[a:b] @ crf.weight
        total, mass, moved = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for path in itertools.product([0, 1], repeat=b - a):
            p = np.exp(sum(s[i] for i, v in enumerate(path) if v)
                       + sum(crf.transition[u, v] for u, v in zip(path, path[1:])))
            total += p
            mass += p * np.array(path)
            for u, v in zip(path, path[1:]):
                moved[u, v] += p
        want[a:b] = mass / total
        pairs += moved / total
    assert np.allclose(got, want) and np.allclose(expected, pairs)


def test_lines_do_not_depend_on_the_batch():
    texts = [b"", b"One line", b"A\n\nB b b\nA", "É ü\n| x | y".encode(), b"\n"]
    together, size, first = quality.line_features(texts)
    assert np.diff(first).tolist() == [1, 1, 4, 2, 2]
    for i, t in enumerate(texts):
        alone, alone_size, _ = quality.line_features([t])
        assert np.allclose(together[first[i]:first[i + 1]], alone)
        assert size[first[i]:first[i + 1]].tolist() == alone_size.tolist() == [len(x) for x in t.split(b"\n")]


def test_held_out_quality(spark):
    got = entry.queries()["op6_quality"](spark, SF).toPandas()
    held = got[got.held_out].merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.93
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert (good.values[:, None] > bad.values[None, :]).mean() > 0.97


def test_a_hot_id_does_not_fill_the_samples(spark):
    """A third of all rows on one id, with many texts: one document of it is taken."""
    hot = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 and _taken(spark, i))
    docs = spark.range(0, 6000, 1, 6).selectExpr(
        f"if(id % 3 = 0, {hot}, id + 100000) AS doc_id", "concat(repeat('word ', 400), id) AS text", "'en' AS lang")
    _, x, y = langid.training_windows(docs)
    ids = docs.selectExpr("doc_id").distinct().count()
    assert 0 < len(x) <= langid.SAMPLE_WINDOWS * min(ids, 3 * langid.SAMPLE_DOCS) and len(x) == len(y)
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS quality")
    gathered = []

    class Fit(quality.LineCRF):
        def fit(self, chains, marks):
            gathered.append((len(chains), max(map(len, chains))))
            return super().fit(chains, marks)

    keep, quality.LineCRF = quality.LineCRF, Fit
    try:
        quality.train(docs, labels, sample_docs=3000)
    finally:
        quality.LineCRF = keep
    (n, lines), = gathered
    assert n <= ids and lines <= quality.SAMPLE_LINES


def _taken(spark, i: int) -> bool:
    return spark.range(1).selectExpr(
        f"pmod(xxhash64({i}L, 'lang'), 1000000) < 60000 AND pmod(xxhash64({i}L, 'quality'), 1000000) < 400000").first()[0]
