"""Operator 13: embedding near-duplicates by Euclidean p-stable hashing.

Two unit vectors with cosine c are sqrt(2 - 2c) apart.  A table's key is made
of ``k`` quantised Gaussian projections floor((a.x + b) / w); equal keys bucket
vectors together, and only vectors of one bucket are compared, by their exact
cosine.  ``k`` grows with the logarithm of the vector count, so that a vector
meets about ``STRANGERS`` unrelated ones in a table, and the number of tables
follows from ``MISS``: a pair right at the threshold is missed by all tables
with at most that probability, a closer pair with less.

Equal vectors are one class with a weight.  A pair of classes is counted in the
first table whose keys agree (keys are sums of integers, the same in any
task), so nothing but sums per vector and a spanning set of links leaves a
task.  Buckets above ``BLOCK`` members are split: members within half the
threshold angle of the bucket's pivot are all linked to each other by the
triangle inequality and are counted as a group without comparing them; the
rest is compared block by block.  Every vector is indexed and compared; no
bucket is capped.

Defined results: a vector that is null, empty, zero or holds null or
non-finite components, and any vector without an id, links with nothing
(n_links 0, component_id its own id, kept).  Vectors of different length link
with nothing.  Equal vectors link at every threshold.  Repeated ids are
separate vectors of the same id.  An empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.llm.common import _splitmix, prepare, seeds, sized, stored, table
from casekit.llm.components import components

THRESHOLD = 0.95
WIDTH = 2.0
STRANGERS = 1.0
MISS = 1e-3
BLOCK = 512
SMALL = 32  # buckets up to this size are compared many at a time
_ONE = float(1 << 20)  # scale of unit components, so sums are exact integers
_UNIT = float(1 << 12)  # scale of the projections


def collide(distance: float, width: float = WIDTH) -> float:
    """Probability that one projection puts points this far apart in one cell."""
    if distance <= 0:
        return 1.0
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan_tables(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(projections a table, tables) for ``n`` vectors."""
    near = collide(math.sqrt(max(0.0, 2 - 2 * threshold)))
    far = collide(math.sqrt(2))  # unrelated vectors are near right angles
    k = max(4, math.ceil(math.log(max(n, 2) / STRANGERS) / -math.log(far)))
    if near >= 1:
        return k, 1
    return k, math.ceil(math.log(MISS) / math.log1p(-near ** k))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Hashes:
    """Keys of every table; the same for a vector in whatever batch it comes."""

    def __init__(self, k: int, tables: int, seed: int = 13) -> None:
        self.k, self.tables, self.seed = k, tables, seed
        self._by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._mix = seeds(k, seed)

    def _projections(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        if dim not in self._by_dim:
            rng = np.random.RandomState(self.seed + dim)
            a = np.rint(rng.standard_normal((dim, self.tables * self.k)) * _UNIT)
            b = np.floor(rng.random_sample(self.tables * self.k) * WIDTH * _ONE * _UNIT)
            self._by_dim[dim] = a, b
        return self._by_dim[dim]

    def keys(self, units: np.ndarray) -> np.ndarray:
        """(rows, tables) of 64-bit keys."""
        a, b = self._projections(units.shape[1])
        out = np.empty((len(units), self.tables), np.uint64)
        for lo in range(0, len(units), 1024):
            cell = np.floor((np.rint(units[lo:lo + 1024] * _ONE) @ a + b) / (WIDTH * _ONE * _UNIT))
            cell = cell.astype(np.int64).view(np.uint64).reshape(len(cell), self.tables, self.k)
            out[lo:lo + 1024] = _splitmix((cell * self._mix).sum(axis=2, dtype=np.uint64))
        return out.view(np.int64)


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def classes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(cid, v, w, first_id): the distinct usable vectors, stored.

    ``cid`` is a number given once, when the table is written.
    """
    usable = vectors.selectExpr(f"`{id_col}` AS id", f"`{vec_col}` AS v").where(
        "id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) "
        "AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)")
    grouped = usable.groupBy("v").agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("first_id"))
    return stored(grouped.select(F.monotonically_increasing_id().alias("cid"), "v", "w", "first_id"),
                  "vec-classes")


def _bucket_keys(rows: DataFrame, hashes: Hashes) -> DataFrame:
    """(t, key, cid) of every class in every table."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("v").value_lengths().to_numpy()
            cids = batch.column("cid").to_numpy()
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                keys = hashes.keys(unit(_matrix(batch.column("v").take(pa.array(at)), int(dim))))
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(hashes.tables, dtype=np.int32), n)),
                     pa.array(keys.ravel() ^ np.int64(dim)), pa.array(np.repeat(cids[at], hashes.tables))],
                    names=["t", "key", "cid"])

    return rows.select("cid", "v").mapInArrow(make, "t int, key bigint, cid bigint")


def _groups(keys: DataFrame, hot: DataFrame, rows: DataFrame, threshold: float) -> DataFrame:
    """(cid, g): members of a hot bucket within half the threshold angle of its
    pivot, each in one group at most: that of its fullest hot bucket."""
    home = (
        keys.join(hot, ["t", "key"]).groupBy("cid")
        .agg(F.expr("max(struct(n, t, key, pivot))").alias("home"))
        .select("cid", "home.t", "home.key", "home.pivot")
    )
    pivots = rows.select(F.col("cid").alias("pivot"), F.col("v").alias("pv"))
    dot = "aggregate(zip_with(v, {0}, (a, b) -> cast(a as double) * b), 0d, (s, x) -> s + x)"
    norm = "aggregate({0}, 0d, (s, x) -> s + cast(x as double) * x)"
    half = math.cos(math.acos(threshold) / 2) + 1e-9
    # Components may be huge: both vectors are scaled by their largest one.
    scaled = "transform({0}, x -> cast(x as double) / array_max(transform({0}, x -> abs(cast(x as double)))))"
    return (
        home.join(pivots, "pivot").join(rows.select("cid", "v"), "cid")
        .where("size(v) = size(pv)")
        .withColumn("v", F.expr(scaled.format("v"))).withColumn("pv", F.expr(scaled.format("pv")))
        .where(f"{dot.format('pv')} >= {half!r} * sqrt({norm.format('v')}) * sqrt({norm.format('pv')})")
        .selectExpr("cid", "xxhash64(t, key) AS g")
    )


def _members(keys: DataFrame, live: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """(t, key, b1, b2, cid, g, side): who is compared with whom, by blocks.

    A bucket up to ``block`` is one task row.  A larger one is cut into blocks
    of one group each; blocks of one group never meet.
    """
    member = keys.join(live, ["t", "key"]).join(groups, "cid", "left")
    small = member.where(f"n <= {block}").selectExpr(
        "t", "key", "0 AS b1", "0 AS b2", "cid", "g", "0 AS side")
    large = stored(member.where(f"n > {block}").select("t", "key", "cid", "g"), "vec-large")
    part = large.groupBy("t", "key", "g").agg(F.count(F.lit(1)).alias("m"))
    part = part.selectExpr("*", f"cast(ceil(m / {block}) as int) AS blocks")
    # Blocks of a bucket in a row: the groups one after another.
    bucket = part.groupBy("t", "key").agg(
        F.expr("array_sort(collect_list(struct(coalesce(g, 0) AS g, g IS NULL AS single, blocks)))").alias("parts"))
    place = bucket.selectExpr(
        "t", "key", "aggregate(parts, 0, (s, p) -> s + p.blocks) AS total",
        "posexplode(parts) AS (i, p)", "parts").selectExpr(
        "t", "key", "total", "p.single AS single", "if(p.single, null, p.g) AS g", "p.blocks AS blocks",
        "aggregate(slice(parts, 1, i), 0, (s, q) -> s + q.blocks) AS base")
    near = large.alias("l").join(
        sized(stored(place, "vec-places")).alias("p"),
        F.expr("l.t = p.t AND l.key = p.key AND l.g <=> p.g"))
    dealt = near.selectExpr(
        "l.t", "l.key", "l.cid", "l.g", "single", "base", "blocks",
        "cast(base + pmod(xxhash64(l.cid), blocks) as int) AS b",
        "explode(sequence(0, total - 1)) AS other")
    meets = dealt.where("single OR other < base OR other >= base + blocks").selectExpr(
        "t", "key", "least(b, other) AS b1", "greatest(b, other) AS b2", "cid", "g", "b AS side")
    return small.union(meets)


def _pairs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All index pairs inside consecutive buckets of these sizes, with the bucket."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    left, right, which = [], [], []
    for m in np.unique(sizes):
        i, j = np.triu_indices(int(m), 1)
        where = np.flatnonzero(sizes == m)
        left.append((at[where][:, None] + i).ravel())
        right.append((at[where][:, None] + j).ravel())
        which.append(np.repeat(where, len(i)))
    return np.concatenate(left), np.concatenate(right), np.concatenate(which)


def _spanning(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links that join the same indices as all pairs (i, j) do: each round, every
    tree is joined to the smallest tree it touches."""
    root, out = np.arange(n), []
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if not len(i):
            break
        high, low = np.maximum(a, b), np.minimum(a, b)
        parent = np.arange(n)
        np.minimum.at(parent, high, low)
        out += [(int(x), int(parent[x])) for x in np.flatnonzero(parent != np.arange(n))]
        while (parent[parent] != parent).any():
            parent = parent[parent]
        root = parent[root]
    return out


def links(rows: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK,
          shape: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """((cid, n) sums of linked weights, (x, y) spanning links) of classes."""
    k, n_tables = shape or plan_tables(rows.count(), threshold)
    hashes = Hashes(k, n_tables)
    keys = stored(_bucket_keys(rows, hashes), "vec-keys")
    live = stored(keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("pivot"))
                  .where("n > 1"), "vec-live")
    groups = stored(_groups(keys, live.where(f"n > {block}"), rows, threshold), "vec-groups")
    member = _members(keys, live.drop("pivot"), groups, block)
    packed = (
        member.join(rows.select("cid", "v", "w", F.size("v").alias("dim")), "cid")
        .groupBy("t", "key", "b1", "b2", "dim")  # vectors of two lengths never meet
        .agg(F.collect_list(F.struct("cid", "w", F.coalesce("g", F.lit(0)).alias("g"),
                                     F.col("g").isNotNull().alias("grouped"), "side", "v")).alias("m"))
        .where("size(m) > 1")
        .selectExpr("t", "b1", "b2", "m.cid AS cid", "m.w AS w", "m.g AS g", "m.grouped AS grouped",
                    "m.side AS side", "dim", "flatten(m.v) AS v")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, b1, b2, dims = (batch.column(c).to_numpy() for c in ("t", "b1", "b2", "dim"))
            size = batch.column("cid").value_lengths().to_numpy()
            bulk = (size <= SMALL) & (b1 == b2)
            jobs = [np.flatnonzero(bulk & (dims == d)) for d in np.unique(dims[bulk])]
            jobs += [np.array([r]) for r in np.flatnonzero(~bulk)]
            for job in jobs:
                get = {c: batch.column(c).take(pa.array(job)).flatten().to_numpy(zero_copy_only=False)
                       for c in ("cid", "w", "g", "grouped", "side")}
                x = unit(_matrix(batch.column("v").take(pa.array(job)), int(dims[job[0]])))
                if bulk[job[0]]:
                    i, j, which = _pairs(size[job])
                    good = ~((get["g"][i] == get["g"][j]) & get["grouped"][i] & get["grouped"][j])
                    i, j, which = i[good], j[good], which[good]
                    near = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
                    i, j, at = i[near], j[near], t[job][which[near]]
                    if not len(i):
                        continue
                    used, back = np.unique(np.concatenate([i, j]), return_inverse=True)
                    own = hashes.keys(x[used])
                    same = own[back[:len(i)]] == own[back[len(i):]]
                    fresh = same.argmax(axis=1) == at
                    i, j = i[fresh], j[fresh]
                else:
                    r = job[0]
                    one = np.flatnonzero(get["side"] == b1[r])
                    two = one if b1[r] == b2[r] else np.flatnonzero(get["side"] == b2[r])
                    if not len(one) or not len(two):
                        continue
                    todo = ~((get["g"][one][:, None] == get["g"][two])
                             & get["grouped"][one][:, None] & get["grouped"][two])
                    if b1[r] == b2[r]:
                        todo &= np.triu(np.ones(todo.shape, bool), 1)
                    own = hashes.keys(x)
                    for before in range(int(t[r])):
                        if not todo.any():
                            break
                        todo &= own[one, before][:, None] != own[two, before]
                    if not todo.any():
                        continue
                    a, b = np.nonzero(todo & (x[one] @ x[two].T >= threshold))
                    i, j = one[a], two[b]
                if not len(i):
                    continue
                n = len(x)
                total = np.zeros(n, np.int64)
                np.add.at(total, i, get["w"][j])
                np.add.at(total, j, get["w"][i])
                some = np.flatnonzero(total)
                tree = np.array(_spanning(i, j, n))
                cid = get["cid"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([cid[some], cid[tree[:, 0]]])),
                     pa.array(np.concatenate([cid[some], cid[tree[:, 1]]])),
                     pa.array(np.concatenate([total[some], np.zeros(len(tree), np.int64)]))],
                    names=["x", "y", "n"])

    # A row with x = y is a sum of weights, any other a link.
    found = stored(packed.mapInArrow(compare, "x bigint, y bigint, n bigint"), "vec-found")
    in_group = groups.join(rows.select("cid", "w"), "cid")
    whole = stored(in_group.groupBy("g").agg(F.sum("w").alias("all"), F.min("cid").alias("head")), "vec-whole")
    in_group = in_group.join(sized(whole), "g")
    sums = (
        found.where("x = y").selectExpr("x AS cid", "n")
        .union(in_group.selectExpr("cid", "all - w AS n"))
        .groupBy("cid").agg(F.sum("n").alias("n"))
    )
    tree = found.where("x <> y").select("x", "y").union(in_group.selectExpr("cid AS x", "head AS y"))
    return sums, tree


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD, block: int = BLOCK,
                    shape: tuple[int, int] | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    rows = classes(vectors, id_col, vec_col)
    sums, tree = links(rows, threshold, block, shape)
    node = components(tree)  # stored: (node, component)
    named = node.join(rows.select(F.col("cid").alias("node"), "first_id"), "node")
    low = stored(named.groupBy("component").agg(F.min("first_id").alias("low")), "vec-low")
    home = node.join(sized(low), "component").select(F.col("node").alias("cid"), "low")
    facts = stored(
        rows.join(sums, "cid", "left").join(home, "cid", "left").selectExpr(
            "v", "w - 1 + coalesce(n, 0) AS n_links", "coalesce(low, first_id) AS component_id"),
        "vec-facts")
    given = vectors.selectExpr(f"`{id_col}` AS vec_id", f"`{vec_col}` AS v")
    # Rows without an id have no class even if their vector has one.
    joined = given.withColumn("v", F.expr("if(vec_id IS NULL, null, v)")).join(facts, "v", "left")
    return joined.selectExpr(
        "vec_id", "coalesce(n_links, 0L) AS n_links", "coalesce(component_id, vec_id) AS component_id",
    ).withColumn("kept", F.expr("vec_id <=> component_id"))


def op13_vector_duplicates(spark, sf_dir: str) -> DataFrame:
    """Contract query: all embeddings, cosine 0.95 or more."""
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH RECURSIVE r AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
    vec_id IS NOT NULL AND coalesce(len(embedding), 0) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings
), u AS (SELECT rid, vec_id, list_filter(v, lambda x: x IS NOT NULL) AS v FROM r WHERE usable),
p AS (
  SELECT a.rid AS x, b.rid AS y FROM u a JOIN u b ON a.rid <> b.rid AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= {THRESHOLD} OR a.v = b.v
), c AS (
  SELECT rid AS x, rid AS y FROM u UNION SELECT c.x, p.y FROM c JOIN p ON c.y = p.x
), low AS (
  SELECT c.x AS rid, min(u.vec_id) AS component_id FROM c JOIN u ON c.y = u.rid GROUP BY c.x
), n AS (SELECT x AS rid, count(*) AS n_links FROM p GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
  vec_id IS NOT DISTINCT FROM coalesce(component_id, vec_id) AS kept
FROM r LEFT JOIN low USING (rid) LEFT JOIN n USING (rid)
"""
