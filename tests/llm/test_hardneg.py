"""Hard negatives against scoring every pair."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casekit.llm import hardneg
from casekit.llm.common import prepare


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 300), st.integers(1, 12), st.integers(1, 5), st.integers(1, 7),
       st.booleans(), st.integers(-40, 40), st.integers(0, 60))
def test_the_tree_never_loses_a_result(seed, n, dim, n_labels, k, same, low, width):
    rng = np.random.default_rng(seed)
    v = rng.integers(-4, 5, (n, dim)).astype(float)  # few values: many ties
    labels, ids = rng.integers(0, n_labels, n), rng.permutation(1000)[:n]
    order = hardneg.str_order(labels, v)
    assert sorted(order) == list(range(n))
    tree = hardneg.Tree(ids[order], labels[order], v[order])
    q = v[: max(1, n // 10)]
    bounds = tree.bounds(q)
    for row in range(len(q)):
        windows = [hardneg.Found(low, low + width), hardneg.Found(low - 9, low + 5)]
        tree.search(row, int(ids[row]), int(labels[row]), same, bounds, windows, k, hardneg.Leaves(tree, q))
        s = v @ q[row]
        for w in windows:
            want = sorted((-int(s[j]), int(ids[j])) for j in range(n)
                          if j != row and (labels[j] == labels[row]) == same and w.low <= s[j] <= w.high)
            assert w.best == want[:k]


def test_boxes_bound_every_score_and_prune():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 6)) * 200
    v = np.floor(np.concatenate([c + rng.normal(size=(hardneg.LEAF, 6)) for c in centres]))
    labels = np.zeros(len(v), np.int64)
    order = hardneg.str_order(labels, v)
    tree = hardneg.Tree(np.arange(len(v)), labels, v[order])
    (lower, upper), s = tree.bounds(v[:5])[0], v[:5] @ v[order].T
    for node in range(lower.shape[1]):
        part = s[:, node * hardneg.LEAF:(node + 1) * hardneg.LEAF]
        assert (lower[:, node] <= part.min(axis=1)).all() and (part.max(axis=1) <= upper[:, node]).all()
    leaves = hardneg.Leaves(tree, v[:5])
    tree.search(0, -1, 0, True, tree.bounds(v[:5]), [hardneg.Found(-hardneg.ANY, hardneg.ANY)], 5, leaves)
    assert len(leaves.read) < 0.5 * lower.shape[1]  # clustered rows: most leaves are never read


def slow(rows, positives=5, negatives=5):
    out = []
    for a, la, va in rows:
        if a % 100:
            continue
        score = [(-sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in rows if i != a and len(v) == len(va)]
        own = sorted((s, i) for s, i, lab in score if lab == la)[:positives]
        for ps, p in own:
            hard = sorted((s, i) for s, i, lab in score
                          if lab != la and 80 * -ps <= 100 * -s <= 100 * -ps)[:negatives]
            out += [(a, p, r, i, -ps, -s) for r, (s, i) in enumerate(hard, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,anchor_block", [(4096, 256), (7, 2)])
def test_blocks_of_any_size_equal_brute_force(spark, block, anchor_block):
    prepare(spark)
    rng = np.random.default_rng(6)
    rows = [(i * 10, int(rng.integers(0, 3)), rng.integers(0, 6, 5).tolist()) for i in range(150)]
    rows += [(2000 + i, 1, rows[0][2]) for i in range(60)]  # one vector in a third of the rows
    rows += [(5000 + i, i % 2, [1, 2]) for i in range(5)]
    df = spark.createDataFrame(rows, "id bigint, label bigint, v array<bigint>").repartition(4)
    got = hardneg.hard_negatives(df, df.where("id % 100 = 0"), block=block, anchor_block=anchor_block)
    assert sorted(map(tuple, got.collect())) == slow(rows)


def test_unusable_rows_take_no_part(spark):
    prepare(spark)
    nan = float("nan")
    rows = [(100, 0, [0.5, 0.5]), (1, 0, [0.5, 0.4]), (2, 1, [0.4, 0.5]), (3, None, [0.45, 0.5]), (4, 1, None),
            (5, 1, [0.45, None]), (6, 1, [0.45, nan]), (7, 0, [0.5, 0.45]), (None, 1, [0.45, 0.5]),
            (200, 2, [-1.0, -1.0]), (8, 1, []), (300, 4, [-1.0, 0.0]), (9, 4, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    use = hardneg.usable_rows(df, label=hardneg.LABEL)
    assert sorted(r.id for r in use.collect()) == [1, 2, 7, 9, 100, 200, 300]
    got = sorted(map(tuple, hardneg.hard_negatives(use, use.where("id % 100 = 0")).collect()))
    # 7 is divisible by seven, so it has another label than 100, but it scores
    # above the positive; 300's positive scores below zero and has no window.
    assert got == [(100, 1, 1, 2, 128 * 230, 128 * 230)]
