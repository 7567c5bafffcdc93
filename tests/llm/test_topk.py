"""Branch and bound against sorting all scores."""

from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from casekit.llm import topk


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 60), st.integers(1, 70), st.integers(1, 6))
def test_bounds_never_lose_a_result(seed, n, dim, k):
    rng = np.random.default_rng(seed)
    c = np.floor(rng.normal(0, 3, (n, dim))).astype(float)  # few values: many ties
    ids = np.sort(rng.permutation(1000)[:n])
    q = c[: max(1, n // 3)]
    for row, got_ids, got in topk.bounded_topk(ids[:len(q)], q, ids, c, k):
        s = c @ q[row]
        order = [j for j in sorted(range(n), key=lambda j: (-s[j], ids[j])) if ids[j] != ids[row]][:k]
        assert got_ids.tolist() == ids[order].tolist() and got.tolist() == s[order].tolist()


def test_many_blocks_give_the_same(spark, awkward):
    vectors = spark.read.parquet(f"{awkward}/embeddings.parquet")
    queries = vectors.where("vec_id % 50 = 0")
    one, many = (sorted(map(tuple, topk.topk(vectors, queries, 5, block=b).collect())) for b in (4096, 2))
    assert one == many and len(one) > 20


def test_a_repeated_id_fills_no_block_alone(spark):
    from pyspark.sql import functions as F

    rows = spark.range(6000).selectExpr(
        "if(id % 3 = 0, 1, id) AS id", "array(cast(id % 7 as bigint), id % 5) AS v", "id AS row")
    sizes = [r.n for r in topk._packed(rows, 20, "c").select(F.size("c_ids").alias("n")).collect()]
    assert len(sizes) == 20 and sum(sizes) == 6000 and max(sizes) < 2 * 300


def test_repeated_ids_in_any_blocks_give_the_same(spark):
    rows = spark.range(400).selectExpr(
        "if(id % 3 = 0, 50, id) AS vec_id", "array(cast(id % 11 as double), cast(id % 4 as double)) AS embedding")
    results = [sorted(map(tuple, topk.topk(rows, rows.where("vec_id % 50 = 0"), 5, block=b).collect()))
               for b in (4096, 30)]
    assert results[0] == results[1] and results[0]
