"""Embedding near-duplicates against comparing all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from casekit.llm import vecdup
from casekit.llm.common import prepare


def brute(ids, vecs, threshold=vecdup.THRESHOLD):
    x = np.array(vecs, dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    low = np.array(ids)
    while True:
        new = np.array([min([low[i], *low[near[i]]]) for i in range(len(low))])
        if (new == low).all():
            break
        low = new
    return sorted((i, int(n), int(c), i == c) for i, n, c in zip(ids, near.sum(axis=1), low))


def clusters(rng, sizes, dim=24, noise=0.02):
    out = []
    for m in sizes:
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        out += [(centre + rng.normal(scale=noise, size=dim)).tolist() for _ in range(m)]
    return out


def run(spark, ids, vecs, **options):
    df = spark.createDataFrame(list(zip(ids, vecs)), "vec_id bigint, embedding array<float>").repartition(3)
    return sorted(map(tuple, vecdup.near_duplicates(df, **options).collect()))


@pytest.mark.parametrize("block", [512, 16])
def test_groups_of_copies_equal_all_pairs(spark, block):
    prepare(spark)
    rng = np.random.default_rng(3)
    vecs = clusters(rng, [1] * 60 + [2] * 20 + [90, 40, 7])
    vecs += [vecs[0]] * 30 + [vecs[-1]] * 5  # equal vectors
    ids = rng.permutation(5000)[:len(vecs)].tolist()
    got = run(spark, ids, vecs, block=block)
    assert got == brute(ids, vecs)
    assert max(g[1] for g in got) >= 89


def test_wide_groups_around_the_threshold(spark):
    """Members near the threshold angle: neither all linked nor all apart."""
    prepare(spark)
    rng = np.random.default_rng(5)
    vecs = clusters(rng, [70, 50], noise=0.045)
    ids = list(range(len(vecs)))
    want = brute(ids, vecs)
    assert 0 < sum(g[1] for g in want) < 70 * 69 + 50 * 49
    for block in (512, 16):
        assert run(spark, ids, vecs, block=block, shape=(2, 60)) == want


def test_recall_right_at_the_threshold(spark):
    """The index as built finds at least 0.9 of pairs at cosine 0.95 exactly."""
    rng = np.random.default_rng(7)
    dim, n = 64, 2000
    a = vecdup.unit(rng.normal(size=(n, dim)))
    side = rng.normal(size=(n, dim))
    side = vecdup.unit(side - (side * a).sum(axis=1, keepdims=True) * a)
    b = 0.95 * a + np.sqrt(1 - 0.95 ** 2) * side
    for rows in (10_000, 1_000_000):
        h = vecdup.Hashes(*vecdup.plan_tables(rows))
        met = (h.keys(a) == h.keys(vecdup.unit(b))).any(axis=1)
        assert met.mean() >= 0.99


def test_keys_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    x = vecdup.unit(rng.normal(size=(300, 64)))
    h = vecdup.Hashes(14, 40)
    assert (h.keys(x)[17] == h.keys(x[17:18])[0]).all() and (h.keys(x)[::-1] == h.keys(x[::-1])).all()


def test_spanning_links_join_the_same():
    rng = np.random.default_rng(2)
    for n in (2, 5, 40):
        i, j = rng.integers(0, n, (2, n))
        i, j = i[i != j], j[i != j]
        tree = vecdup._spanning(i, j, n)
        assert len(tree) < n
        for pairs in (list(zip(i, j)), tree):
            low = np.arange(n)
            for _ in range(n):
                for a, b in pairs:
                    low[[a, b]] = min(low[a], low[b])
            first = low if pairs is not tree else first
            if pairs is tree:
                assert (low == first).all()


def test_a_third_of_all_rows_is_one_vector(spark):
    prepare(spark)
    rng = np.random.default_rng(9)
    other = rng.normal(size=(40, 8)).tolist()
    df = spark.range(3000).selectExpr("id AS vec_id").rdd.map(
        lambda r: (r.vec_id, [1.0] * 8 if r.vec_id % 3 == 0 else other[r.vec_id % 40]))
    df = spark.createDataFrame(df, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in vecdup.near_duplicates(df).collect()}
    assert len(got) == 3000 and got[3].n_links == 999 and got[3].component_id == 0 and not got[3].kept
    assert got[0].kept
