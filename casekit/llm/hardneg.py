"""Operator 11: hard-negative mining on an STR-packed R-tree.

For each anchor, its positives are the rows of its own label with the highest
scores (integer inner products), and for each positive the negatives are the
rows of other labels with the highest scores inside a window below the
positive's score.

Rows are packed into blocks of up to ``BLOCK`` vectors, ranged by label and
first component.  A block is an R-tree packed by sort-tile-recursive order:
label first, then the coordinates in order of their spread.  A node's minimum
bounding box gives, per coordinate, the interval of its products with the
anchor; their sums bound every score below the node.  Nodes wait in a queue,
best upper bound first; boxes that lie outside the score window, whose labels
cannot qualify, or whose upper bound is strictly below the k-th score are
pruned, so the result is exact and ties go to the smaller id.  Blocks of
anchors meet blocks of rows; a task keeps an anchor's best from block to block.

Defined results: rows with a null id, a null label, a null or empty vector, or
one holding null or non-finite components take no part.  Vectors of different
length have no inner product and are searched only among their own length.  A
row is never its own partner, nor is another row of the same id.  Repeated ids
are separate rows.  Anchors without a positive, and positives without a
negative in the window, give no rows; a positive with a score below zero has
an empty window.  Scores must stay below 2**53, or the query fails rather than
round.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casekit.llm.common import prepare, stored, table

BLOCK = 4096
ANCHOR_BLOCK = 256
SWEEP = 4  # row blocks a task takes for one block of anchors
LEAF = 64
FANOUT = 8
ANY = 1 << 62  # beyond every score


def usable_rows(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                label: str = "label", scale: int = 256) -> DataFrame:
    """(id, label, v array<bigint>): rows that take part, floor(scale * x)."""
    x = f"transform(`{vec_col}`, x -> cast(x as double))"
    return (
        vectors.selectExpr(f"cast(`{id_col}` as bigint) AS id", f"cast({label} as bigint) AS label", f"{x} AS x")
        .where("id IS NOT NULL AND label IS NOT NULL AND size(x) > 0 AND forall(x, v -> v IS NOT NULL "
               "AND NOT isnan(v) AND abs(v) < double('Infinity'))")
        .selectExpr("id", "label", f"transform(x, v -> cast(floor({scale} * v) as bigint)) AS v")
    )


def str_order(labels: np.ndarray, v: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Row order by sort-tile-recursive packing: slabs by label, then slabs of
    slabs by one coordinate after the other, down to leaves."""
    spread = np.argsort(-v.var(axis=0), kind="stable")
    out = []
    stack = [(np.argsort(labels, kind="stable"), -1)]
    while stack:
        rows, depth = stack.pop()
        if depth >= 0:
            if len(rows) <= leaf or depth >= len(spread):
                out.append(rows)
                continue
            rows = rows[np.argsort(v[rows, spread[depth]], kind="stable")]
            leaves = -(-len(rows) // leaf)
            slabs = max(2, int(np.ceil(leaves ** (1 / (len(spread) - depth)))))
        else:
            slabs = max(1, int(np.sqrt(-(-len(rows) // leaf))))
        step = -(-(-(-len(rows) // slabs)) // leaf) * leaf  # whole leaves
        parts = [rows[i:i + step] for i in range(0, len(rows), step)]
        stack += [(p, depth + 1) for p in reversed(parts)]
    return np.concatenate(out) if out else np.empty(0, np.int64)


class Tree:
    """R-tree over rows already in packing order; level 0 are the leaves."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray) -> None:
        self.ids, self.labels, self.v = ids, labels, v
        at = np.arange(0, len(v), LEAF)
        self.levels = [(np.minimum.reduceat(v, at), np.maximum.reduceat(v, at),
                        np.minimum.reduceat(labels, at), np.maximum.reduceat(labels, at))]
        while len(self.levels[-1][0]) > 1:
            lo, hi, la, lb = self.levels[-1]
            at = np.arange(0, len(lo), FANOUT)
            self.levels.append((np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                                np.minimum.reduceat(la, at), np.maximum.reduceat(lb, at)))

    def bounds(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level (lower, upper) bounds of the scores under each node, a row
        for each vector of ``q``: sums of the per-coordinate intervals."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return [(up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T) for lo, hi, *_ in self.levels]

    def fitting(self, label: int, same: bool) -> list[np.ndarray]:
        """Per level, nodes that may hold rows of (``same``) or beside ``label``."""
        if same:
            return [(la <= label) & (label <= lb) for *_, la, lb in self.levels]
        return [(la != label) | (lb != label) for *_, la, lb in self.levels]

    def search(self, row: int, own: int, label: int, same: bool, bounds, windows: list[Found], k: int,
               leaves: Leaves) -> None:
        """Add this tree's rows to the anchor's ``windows``, all in one descent."""
        fits = self.fitting(label, same)
        high = max(w.high for w in windows)
        need = min(w.need(k) for w in windows)
        queue: list[tuple[float, int, int]] = []

        def push(level: int, a: int, b: int) -> None:
            lower, upper = bounds[level][0][row, a:b], bounds[level][1][row, a:b]
            good = fits[level][a:b] & (upper >= need) & (lower <= high)
            for i in np.flatnonzero(good).tolist():
                heapq.heappush(queue, (-upper[i], level, a + i))

        push(len(self.levels) - 1, 0, len(self.levels[-1][0]))
        while queue:
            u, level, node = heapq.heappop(queue)
            if -u < need:
                break  # nothing left in the queue can reach a window's k-th score
            if level:
                push(level - 1, node * FANOUT, (node + 1) * FANOUT)
                continue
            score = leaves.scores(node)[row]
            for i in np.flatnonzero((score >= need) & (score <= high)).tolist():
                at = node * LEAF + i
                if (self.labels[at] == label) == same and self.ids[at] != own:
                    for w in windows:
                        w.add(int(score[i]), int(self.ids[at]), k)
            need = min(w.need(k) for w in windows)


class Leaves:
    """Scores of a leaf's rows, worked out for a block of anchors at once when
    the first of them reaches the leaf."""

    def __init__(self, tree: Tree, q: np.ndarray) -> None:
        self.tree, self.q = tree, q
        self.read: dict[int, np.ndarray] = {}

    def scores(self, node: int) -> np.ndarray:
        if node not in self.read:
            self.read[node] = self.q @ self.tree.v[node * LEAF:(node + 1) * LEAF].T
        return self.read[node]


class Found:
    """The best (-score, id) inside a window of scores so far."""

    def __init__(self, low: int, high: int) -> None:
        self.low, self.high = low, high
        self.best: list[tuple[int, int]] = []

    def need(self, k: int) -> int:
        """The least score that can still enter (a tie may, by its id)."""
        return self.low if len(self.best) < k else max(self.low, -self.best[-1][0])

    def add(self, score: int, row_id: int, k: int) -> None:
        if self.low <= score <= self.high:
            insort(self.best, (-score, row_id))
            del self.best[k:]


def row_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(c_block, dim, c_ids, c_labels, c_v): rows in blocks, in packing order.

    Rows are ranged by length, label, first component and id, so neither a hot
    label nor a repeated vector grows a task.
    """
    n = max(1, -(-rows.count() // block))
    keys = ["dim", "label", "first", "id"]
    ranged = rows.selectExpr("size(v) AS dim", "label", "v[0] AS first", "id", "xxhash64(v) AS salt", "v")
    ranged = ranged.repartitionByRange(n, *keys, "salt").sortWithinPartitions(*keys)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 24
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        dim_held, count = 0, 0

        def emit():
            nonlocal number, held, count
            ids, labels, v = (np.concatenate(x) for x in zip(*held))
            order = str_order(labels, v)
            number, held, count = number + 1, [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([dim_held], pa.int32()), pa.array([ids[order]]),
                 pa.array([labels[order]]), pa.array([v[order].ravel()])],
                names=["c_block", "dim", "c_ids", "c_labels", "c_v"])

        for batch in batches:
            ids, labels, dims = (batch.column(c).to_numpy() for c in ("id", "label", "dim"))
            at = 0
            while at < len(dims):
                if count and (count == block or dims[at] != dim_held):
                    yield emit()
                dim_held = int(dims[at])
                end = at + min(block - count, int(np.searchsorted(dims[at:], dim_held, "right")))
                v = batch.column("v").slice(at, end - at).flatten().to_numpy().reshape(-1, dim_held)
                held.append((ids[at:end], labels[at:end], v))
                count += end - at
                at = end
        if count:
            yield emit()

    return stored(ranged.select("id", "label", "dim", "v").mapInArrow(
        pack, "c_block bigint, dim int, c_ids array<bigint>, c_labels array<bigint>, c_v array<bigint>"),
        "hn-blocks")


def _search(blocks: DataFrame, anchors: DataFrame, same: bool, k: int,
            low_pct: int = 0, high_pct: int = 0, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(akey, window, id, score): ``k`` best rows per anchor and window, and
    perhaps more of them (the best of each task).

    ``anchors`` has akey, id, label, v and scores (array<bigint>), one window
    each; ``same`` anchors have one window over all scores.
    """
    q_blocks = max(1, -(-anchors.count() // anchor_block))
    sweeps = max(1, -(-blocks.count() // SWEEP))
    q = (
        anchors.withColumn("q_block", F.expr(f"cast(pmod(xxhash64(akey), {q_blocks}) as int)"))
        .groupBy(F.size("v").alias("dim"), "q_block")
        .agg(F.sort_array(F.collect_list(F.struct("akey", "id", "label", "v", "scores"))).alias("r"))
        .selectExpr("dim", "q_block", "r.akey AS q_keys", "r.id AS q_ids", "r.label AS q_labels",
                    "flatten(r.v) AS q_v", "r.scores AS q_scores")
        .withColumn("sweep", F.explode(F.sequence(F.lit(0), F.lit(sweeps - 1))))
    )
    c = (
        blocks.withColumn("sweep", F.expr(f"cast(pmod(xxhash64(c_block), {sweeps}) as int)"))
        .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    )
    met = c.join(q, ["dim", "q_block", "sweep"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        best: dict[int, list[Found]] = {}

        def emit():
            flat = [(a, w, i, -s) for a, found in best.items() for w, f in enumerate(found) for s, i in f.best]
            columns = list(zip(*flat)) or [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                 pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())],
                names=["akey", "window", "id", "score"])

        for batch in batches:
            for r in range(batch.num_rows):
                get = {n: batch.column(n)[r] for n in batch.schema.names}
                dim, at = get["dim"].as_py(), (get["dim"].as_py(), get["q_block"].as_py(), get["sweep"].as_py())
                if at != now:
                    if best:
                        yield emit()
                    now, best = at, {}
                flat = {n: get[n].values.to_numpy() for n in ("c_ids", "c_labels", "q_keys", "q_ids", "q_labels")}
                q_v, c_v = (get[n].values.to_numpy().reshape(-1, dim).astype(np.float64) for n in ("q_v", "c_v"))
                # Exact while every sum stays below 2**53.
                if np.abs(q_v).max() * np.abs(c_v).max() * dim >= 2.0 ** 53:
                    raise OverflowError("quantised components too large for exact scores")
                tree = Tree(flat["c_ids"], flat["c_labels"], c_v)
                bounds, leaves = tree.bounds(q_v), Leaves(tree, q_v)
                scores = get["q_scores"].as_py()
                for i, akey in enumerate(flat["q_keys"].tolist()):
                    if akey not in best:
                        best[akey] = [Found(-ANY, ANY)] if same else [
                            Found(-(-low_pct * x // 100), high_pct * x // 100) for x in scores[i]]
                    tree.search(i, int(flat["q_ids"][i]), int(flat["q_labels"][i]), same, bounds,
                                best[akey], k, leaves)
        if best:
            yield emit()

    return met.mapInArrow(run, "akey bigint, window int, id bigint, score bigint")


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5,
                   low_pct: int = 80, high_pct: int = 100, block: int = BLOCK,
                   anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` and ``anchors`` are (id, label, v) as ``usable_rows`` makes them.
    """
    blocks = row_blocks(stored(rows, "hn-rows"), block)
    asked = stored(anchors.select(F.monotonically_increasing_id().alias("akey"), "id", "label", "v"), "hn-anchors")
    found = _search(blocks, asked.withColumn("scores", F.array(F.lit(0).cast("bigint"))), True, positives,
                    anchor_block=anchor_block)
    order = Window.partitionBy("akey").orderBy(F.desc("score"), "id")
    own = stored(found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= positives), "hn-positives")
    # At most ``positives`` of them an anchor; equal scores share a window.
    listed = own.groupBy("akey").agg(F.sort_array(F.collect_set("score"), asc=False).alias("scores"))
    asked = stored(asked.join(listed, "akey"), "hn-asked")
    found = _search(blocks, asked, False, negatives, low_pct, high_pct, anchor_block)
    order = Window.partitionBy("akey", "window").orderBy(F.desc("score"), "id")
    hard = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    hard = hard.join(asked.select("akey", F.col("id").alias("anchor_id"), "scores"), "akey").selectExpr(
        "akey", "anchor_id", "scores[window] AS positive_score", "cast(rank as int) AS rank",
        "id AS negative_id", "score AS negative_score")
    return (
        own.selectExpr("akey", "id AS positive_id", "score AS positive_score")
        .join(hard, ["akey", "positive_score"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


# The contract's labels: moved on by one where the id is divisible by seven.
LABEL = "if(vec_id % 7 = 0, (label + 1) % 10, label)"


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Contract query: anchors are the rows whose id is divisible by 100."""
    prepare(spark)
    rows = usable_rows(table(spark, sf_dir, "embeddings"), label=LABEL)
    return hard_negatives(rows, rows.where("id % 100 = 0"))


ORACLE = """
WITH r AS (
  SELECT row_number() OVER () AS rid, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS lab,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, c.rid, c.vec_id, a.lab = c.lab AS same,
    CAST(list_sum(list_transform(generate_series(1, len(a.v)), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
  FROM r a JOIN r c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.arid, p.rid ORDER BY n.score DESC, n.vec_id) AS INT) AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.arid = n.arid AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""
