"""Operator 3: exact top-k inner-product search, columnar branch and bound.

Vectors are quantised to integers.  Queries and candidates are packed into
bounded blocks (about ``BLOCK`` vectors each, chosen by a hash of id and row
number, so repeated rows of an id spread as well); every query block
meets every candidate block in one task, never a pair of rows in a join.  In
a task the candidate block lies in vertical layout (dimension x vector).
Scores accumulate one block of dimensions at a time; after each, what the
remaining dimensions can still add is bounded by the product of the remaining
norms (Cauchy-Schwarz), and candidates whose upper bound falls below the
query's k-th best lower bound are compacted away.  Ties at the bound are kept,
so the result is exact.

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do rows with a null id.  Vectors of different
length have no inner product and are searched only among their own length.
Ties go to the smaller id.  Repeated ids are separate candidates of the same
id; a query never meets its own id.  Fewer than k candidates: all of them.
Integers must stay below 2**31 in size, or the query fails rather than
round.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casekit.llm.common import prepare, stored, table

BLOCK = 4096
DIM_BLOCK = 16
QUERY_GROUP = 64


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, v array<bigint>): floor(scale * x) of every usable vector."""
    x = f"transform(`{vec_col}`, x -> cast(x as double))"
    return (
        vectors.selectExpr(f"cast(`{id_col}` as bigint) AS id", f"{x} AS x")
        .where("id IS NOT NULL AND size(x) > 0 AND forall(x, v -> v IS NOT NULL "
               "AND NOT isnan(v) AND abs(v) < double('Infinity'))")
        .selectExpr("id", f"transform(x, v -> cast(floor({scale} * v) as bigint)) AS v")
    )


def _packed(rows: DataFrame, blocks: int, prefix: str) -> DataFrame:
    """One row per (length, block): ids and components as flat arrays.

    ``blocks`` grows with the row count, so a group stays near ``BLOCK``
    vectors.
    """
    return (
        rows.withColumn("b", F.expr(f"cast(pmod(xxhash64(id, row), {blocks}) as int)"))
        .withColumn("dim", F.size("v"))
        .groupBy("dim", "b")
        .agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("r"))
        .selectExpr("dim", f"b AS {prefix}_block", f"r.id AS {prefix}_ids",
                    f"flatten(r.v) AS {prefix}_v")
    )


def bounded_topk(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray,
                 k: int, dim_block: int = DIM_BLOCK):
    """Top ``k`` of candidates ``c`` for each query: (query row, ids, scores).

    ``c_ids`` ascend, so a stable sort by score leaves ties in id order.
    """
    dim = q.shape[1]
    cuts = list(range(0, dim, dim_block)) + [dim]
    vertical = [np.ascontiguousarray(c[:, a:b].T) for a, b in zip(cuts, cuts[1:])]

    def rest(m: np.ndarray) -> list[np.ndarray]:
        sq = [(m[:, a:b] ** 2).sum(axis=1) for a, b in zip(cuts, cuts[1:])]
        tail = np.zeros(len(m))
        out = [tail]
        for s in reversed(sq[1:]):
            tail = tail + s
            out.append(tail)
        # Rounded up a little, so a bound is never below the true value.
        return [np.sqrt(t) * (1 + 1e-12) for t in reversed(out)]

    q_rest, c_rest = rest(q), rest(c)
    for g in range(0, len(q), QUERY_GROUP):
        first = q[g:g + QUERY_GROUP, :cuts[1]] @ vertical[0]
        for i in range(len(first)):
            row = g + i
            alive = np.flatnonzero(c_ids != q_ids[row])
            score = first[i, alive]
            for step in range(1, len(vertical) + 1):
                slack = q_rest[step - 1][row] * c_rest[step - 1][alive]
                if len(alive) > k:
                    low = score - slack
                    floor = np.partition(low, len(low) - k)[len(low) - k]
                    keep = score + slack >= floor
                    if not keep.all():
                        alive, score = alive[keep], score[keep]
                if step < len(vertical):
                    a, b = cuts[step], cuts[step + 1]
                    score = score + q[row, a:b] @ vertical[step][:, alive]
            best = np.argsort(-score, kind="stable")[:k]
            yield row, c_ids[alive[best]], score[best]


def topk(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
         vec_col: str = "embedding", scale: int = 256, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row of ``queries``."""
    number = F.monotonically_increasing_id()
    cand = stored(quantised(vectors, id_col, vec_col, scale).withColumn("row", number), "topk-candidates")
    ask = stored(quantised(queries, id_col, vec_col, scale).withColumn("row", number), "topk-queries")
    # Two counts and the blocks they need: plain numbers, whatever the size.
    c_blocks = max(1, -(-cand.count() // block))
    q_blocks = max(1, -(-ask.count() // block))
    c_rows = (
        _packed(cand, c_blocks, "c")
        .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    )
    pairs = c_rows.join(_packed(ask, q_blocks, "q"), ["dim", "q_block"])
    # One row per pair of blocks; dealt out by the pair so all cores share them.
    pairs = pairs.repartition("dim", "q_block", "c_block")
    schema = "query_id bigint, vec_id bigint, score bigint"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = {n: batch.column(n)[i] for n in batch.schema.names}
                dim = get["dim"].as_py()
                q_ids, c_ids = (get[n].values.to_numpy() for n in ("q_ids", "c_ids"))
                q, c = (get[n].values.to_numpy().reshape(-1, dim).astype(np.float64)
                        for n in ("q_v", "c_v"))
                # Exact while every sum stays below 2**53.
                if np.abs(q).max() * np.abs(c).max() * dim >= 2.0 ** 53:
                    raise OverflowError("quantised components too large for exact scores")
                out_q, out_c, out_s = [], [], []
                for row, ids, scores in bounded_topk(q_ids, q, c_ids, c, k):
                    out_q.append(np.full(len(ids), q_ids[row]))
                    out_c.append(ids)
                    out_s.append(scores.astype(np.int64))
                if out_q:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in (out_q, out_c, out_s)],
                        names=["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(search, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .selectExpr("query_id", "cast(rank as int) AS rank", "vec_id", "score")
    )


def op3_exact_topk(spark, sf_dir: str) -> DataFrame:
    """Contract query: 5 best for every vector whose id is divisible by 50."""
    prepare(spark)
    vectors = table(spark, sf_dir, "embeddings")
    return topk(vectors, vectors.where("vec_id % 50 = 0"), 5)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
  vec_id, score
FROM s QUALIFY rank <= 5
"""
