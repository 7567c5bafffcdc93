"""Operator 2: MinHash near-duplicates with tensored banding.

Two small collections of ``HALVES`` half keys are made per document, each from
``ROWS`` min-hashes; a table key combines one half key of each collection, so
HALVES^2 tables need only 2 * HALVES * ROWS min-hashes.  Half keys that occur
once can meet nobody and are dropped before keys are formed.

Documents with equal shingle sets are one class from the start.  In every
bucket the smallest and largest id are compared with all members; the links
confirmed give components.  Buckets of up to three members are then complete;
in larger ones that still hold several components, members of different
components are compared too (in blocks, so a hot bucket spreads over many
tasks).  Pairs inside one component need no comparison: they cannot change
the result.  Of the others only those are compared that share one of their
rarest shingles, as two sets of the needed similarity must (prefix filter):
a copy that was changed too much for any link has none to share, so a large
group of copies costs no comparison of all with all.  Candidates must agree in
enough min-hashes, and every link is confirmed on the full shingle sets made
from the whole texts.

Defined results: a null or empty text, or one without words, has an empty set
(n_shingles 0) and is linked with nothing.  Fewer words than a shingle: the
whole sequence is one shingle.  Rows sharing an id share component and fate.
A null id is linked with nothing: component null, kept.  An empty table gives
an empty result.  Extra columns are ignored by the query and kept by
``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.llm.common import SPACES, Words, _splitmix, prepare, seeds, sized, slices, stored, table
from casekit.llm.components import components

SHINGLE = 5
PERCENT = 80
HALVES = 12  # half keys in each of the two collections
ROWS = 3  # min-hashes in a half key
N_HASHES = 2 * HALVES * ROWS
# A pair at the threshold agrees in 0.8 * 72 = 57.6 min-hashes on average,
# with a deviation of 3.4; fewer than 43 is a chance of 1 in 100,000.
MIN_AGREE = int(0.6 * N_HASHES)
SLICE_BYTES = 1 << 18  # hashed at once: work arrays stay in cache
BLOCK = 1024  # members of a bucket compared in one task

_ORDER = np.uint64(0xA0761D6478BD642F)
_MUL, _XOR = seeds(N_HASHES, 101), seeds(N_HASHES, 202)
_HALF = seeds(2 * HALVES, 303)


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending, and their bounds."""
    words = Words(texts, SPACES)
    h, first = words.hash, words.first
    n_words = np.diff(first)
    counts = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    start = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - first[:-1], counts)
    size = np.repeat(np.minimum(n_words, k), counts)
    out = np.zeros(len(start), dtype=np.uint64)
    for i in range(k):
        use = size > i
        out[use] = out[use] * _ORDER + h[start[use] + i]
    out = _splitmix(out + size.astype(np.uint64))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        out[a:b].sort()
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[bounds[:-1][counts > 0]] = True
    return out[fresh], np.concatenate([[0], np.cumsum(fresh)])[bounds]


def _reduce(values: np.ndarray, bounds: np.ndarray, how: np.ufunc) -> np.ndarray:
    """Per-text reduction; texts with an empty set get 0."""
    out = np.zeros(len(bounds) - 1, dtype=values.dtype)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = how.reduceat(values, bounds[full])
    return out


def sketch(texts: list[bytes], k: int) -> dict[str, np.ndarray]:
    """Set size, 128-bit set fingerprint, half keys and min-hash sketch."""
    sets, bounds = shingle_sets(texts, k)
    mins = np.stack([_reduce((sets ^ x) * m, bounds, np.minimum) for m, x in zip(_MUL, _XOR)], axis=1)
    mins = _splitmix(mins)
    half = np.zeros((len(texts), 2 * HALVES), dtype=np.uint64)
    for r in range(ROWS):
        half = half * _ORDER + mins[:, r::ROWS]
    return {
        "n": np.diff(bounds),
        "f1": _reduce(_splitmix(sets + np.uint64(1)), bounds, np.add).view(np.int64),
        "f2": _reduce(_splitmix(sets ^ _ORDER), bounds, np.add).view(np.int64),
        "half": _splitmix(half + _HALF).view(np.int64),
        "sig": (mins >> np.uint64(48)).astype("<u2"),
    }


def sketches(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(doc_id, n, f1, f2, half, sig) of every document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("body").to_pylist()]
            for lo, hi in slices([len(t) for t in texts], SLICE_BYTES):
                s = sketch(texts[lo:hi], k)
                flat = pa.array(s["half"].ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(s["n"].astype(np.int64)),
                     pa.array(s["f1"]), pa.array(s["f2"]),
                     pa.ListArray.from_arrays(
                         np.arange(0, len(flat) + 1, 2 * HALVES, dtype=np.int32), flat),
                     pa.array([row.tobytes() for row in s["sig"]], pa.binary())],
                    names=["doc_id", "n", "f1", "f2", "half", "sig"])

    return docs.selectExpr(
        f"cast(`{id_col}` as bigint) AS doc_id", f"cast(`{text_col}` as binary) AS body"
    ).mapInArrow(make, "doc_id bigint, n bigint, f1 bigint, f2 bigint, half array<bigint>, sig binary")


def table_keys(reps: DataFrame) -> DataFrame:
    """(key, rep): one row per table in which the class could meet another."""
    halves = reps.selectExpr("rep", "posexplode(half) AS (t, hk)")
    shared = stored(
        halves.groupBy("hk").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("hk"),
        "shared-halves")
    alive = halves.join(sized(shared), "hk").groupBy("rep").agg(
        F.collect_list(F.expr(f"if(t < {HALVES}, hk, null)")).alias("left"),
        F.collect_list(F.expr(f"if(t >= {HALVES}, hk, null)")).alias("right"))
    # At most HALVES values on either side.
    return (
        alive.select("rep", F.explode("left").alias("l"), "right")
        .select("rep", "l", F.explode("right").alias("r"))
        .selectExpr("xxhash64(l, r) AS key", "rep"))


def _agreeing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs whose sketches agree in at least ``MIN_AGREE`` min-hashes."""
    sigs = reps.select("rep", "sig")
    both = (
        pairs.join(sigs.withColumnsRenamed({"rep": "x", "sig": "sx"}), "x")
        .join(sigs.withColumnsRenamed({"rep": "y", "sig": "sy"}), "y"))

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2")
                        .reshape(-1, N_HASHES) for c in ("sx", "sy"))
                keep = pa.array((a == b).sum(axis=1) >= MIN_AGREE)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("x").filter(keep), batch.column("y").filter(keep)], names=["x", "y"])

    return both.select("x", "y", "sx", "sy").mapInArrow(agree, "x bigint, y bigint")


def confirmed(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int,
              percent: int = PERCENT) -> DataFrame:
    """Stored (x, y) pairs that are links on their full shingle sets."""
    ids = stored(pairs.selectExpr("explode(array(x, y)) AS id").distinct(), "pair-ids")
    texts = stored(
        docs.selectExpr(f"cast(`{id_col}` as bigint) AS id", f"cast(`{text_col}` as binary) AS body")
        .join(sized(ids), "id"), "pair-texts")
    both = (
        pairs.join(texts.withColumnsRenamed({"id": "x", "body": "tx"}), "x")
        .join(texts.withColumnsRenamed({"id": "y", "body": "ty"}), "y")
        .select("x", "y", "tx", "ty"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("x", "y", "tx", "ty"))))
            for lo, hi in slices([len(r[2] or b"") + len(r[3] or b"") for r in rows], 1 << 21):
                number: dict[bytes, int] = {}
                at = [(number.setdefault(r[2] or b"", len(number)),
                       number.setdefault(r[3] or b"", len(number))) for r in rows[lo:hi]]
                sets, bounds = shingle_sets(list(number), k)
                keep = []
                for (x, y, _, _), (i, j) in zip(rows[lo:hi], at):
                    a, b = sets[bounds[i]:bounds[i + 1]], sets[bounds[j]:bounds[j + 1]]
                    merged = np.concatenate([a, b])
                    merged.sort()
                    inter = int((merged[1:] == merged[:-1]).sum())
                    if 100 * inter >= percent * (len(a) + len(b) - inter) and inter:
                        keep.append((x, y))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in keep], pa.int64()),
                     pa.array([p[1] for p in keep], pa.int64())], names=["x", "y"])

    return stored(both.mapInArrow(check, "x bigint, y bigint"), "links")


def _ordered(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(f"{a} <> {b}").selectExpr(f"least({a}, {b}) AS x", f"greatest({a}, {b}) AS y")


def _prefixes(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int,
              percent: int) -> DataFrame:
    """(rep, n, skip, prefix): the shingles of which linked sets must share one.

    Sets of n and m shingles at the threshold share ``ceil(percent * n / 100)``
    or more, so they meet in the first ``n - ceil(...) + 1`` shingles of any
    common order.  The order is rarest first among ``ids``; the ``skip``
    shingles that only this set has come first and meet nobody.  Sets without
    a shared shingle in their prefix are left out.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, texts = batch.column("rep"), [t or b"" for t in batch.column("body").to_pylist()]
            for lo, hi in slices([len(t) for t in texts], SLICE_BYTES):
                sets, bounds = shingle_sets(texts[lo:hi], k)
                yield pa.RecordBatch.from_arrays(
                    [reps.slice(lo, hi - lo),
                     pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(sets.view(np.int64)))],
                    names=["rep", "s"])

    sets = stored(
        docs.selectExpr(f"cast(`{id_col}` as bigint) AS rep", f"cast(`{text_col}` as binary) AS body")
        .join(sized(ids), "rep").mapInArrow(explode, "rep bigint, s array<bigint>"), "candidate-sets")
    single = sets.select("rep", F.explode("s").alias("sh"))
    common = stored(
        single.groupBy("sh").agg(F.count(F.lit(1)).alias("f")).where("f > 1"), "common-shingles")
    shared = (
        single.join(common, "sh").groupBy("rep")
        .agg(F.array_sort(F.collect_list(F.struct("f", "sh"))).alias("c"))  # one text's shingles
        .join(sets.selectExpr("rep", "size(s) AS n"), "rep"))
    # Room left in the prefix after the shingles of this set alone.
    room = f"(n - cast(ceil({percent} * n / 100) as int) + 1) - (n - size(c))"
    return shared.where(f"{room} > 0").selectExpr(
        "rep", "n", "n - size(c) AS skip", f"slice(c, 1, {room}).sh AS prefix")


def _across(keys: DataFrame, buckets: DataFrame, comps: DataFrame, reps: DataFrame, docs: DataFrame,
            id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """Pairs of different components that meet in a bucket of four or more."""
    member = (
        keys.join(sized(buckets.where("c > 3")), "key")
        .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .selectExpr("key", "rep", "coalesce(component, rep) AS comp"))
    member = stored(member, "bucket-members")
    mixed = (
        member.groupBy("key").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("c"),
            F.expr("bit_xor(xxhash64(rep, 1L))").alias("h1"), F.expr("bit_xor(xxhash64(rep, 2L))").alias("h2"))
        .where("lo < hi"))
    # Buckets with equal members hold equal pairs: one of them is enough.
    mixed = stored(
        mixed.groupBy("c", "h1", "h2").agg(F.min("key").alias("key"))
        .selectExpr("key", f"cast(ceil(c / {BLOCK}) as int) AS blocks"), "mixed-buckets")
    met = stored(member.join(sized(mixed), "key"), "mixed-members")
    ids = stored(met.select("rep").distinct(), "mixed-ids")
    prefixes = stored(_prefixes(ids, docs, id_col, text_col, k, percent), "prefixes")
    rows = (
        met.join(prefixes, "rep").join(reps.select("rep", "sig"), "rep")
        .withColumn("b", F.expr("cast(pmod(xxhash64(rep, 3L), blocks) as int)"))
        .withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)")))
        .selectExpr("key", "least(b, o) AS p", "greatest(b, o) AS q", "b", "rep", "comp", "sig",
                    "n", "skip", "prefix"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group = None

        def pairs() -> pa.RecordBatch:
            _, p, q = group
            block = np.array([r[0] for r in held])
            rep = np.array([r[1] for r in held], dtype=np.int64)
            comp = np.array([r[2] for r in held], dtype=np.int64)
            sig = np.frombuffer(b"".join(r[3] for r in held), "<u2").reshape(-1, N_HASHES)
            n, skip = (np.array([r[c] for r in held], dtype=np.int64) for c in (4, 5))
            having: dict[int, list[tuple[int, int]]] = {}
            for i, r in enumerate(held):
                for at, token in enumerate(r[6]):
                    having.setdefault(token, []).append((i, at))
            posts = {t: np.array(x).T for t, x in having.items() if len(x) > 1}
            # Every wanted pair has a member outside the largest component.
            names, size = np.unique(comp, return_counts=True)
            largest = comp == names[size.argmax()]
            met_by = np.full(len(held), -1)
            xs, ys = [], []
            for i in np.flatnonzero(~largest).tolist():
                for at, token in enumerate(held[i][6]):
                    if token not in posts:
                        continue
                    other, other_at = posts[token]
                    # The first shingle two sets share bounds what they share.
                    new = (met_by[other] != i) & (comp[other] != comp[i]) & (largest[other] | (other > i))
                    if p != q:
                        new &= block[other] != block[i]
                    other, other_at = other[new], other_at[new]
                    met_by[other] = i
                    most = np.minimum(n[i] - skip[i] - at, n[other] - skip[other] - other_at)
                    other = other[most * (100 + percent) >= percent * (n[i] + n[other])]
                    other = other[(sig[other] == sig[i]).sum(axis=1) >= MIN_AGREE]
                    xs.append(np.minimum(rep[i], rep[other]))
                    ys.append(np.maximum(rep[i], rep[other]))
            xs, ys = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (xs, ys))
            return pa.RecordBatch.from_arrays([pa.array(xs), pa.array(ys)], names=["x", "y"])

        for batch in batches:
            cols = [batch.column(c).to_pylist()
                    for c in ("key", "p", "q", "b", "rep", "comp", "sig", "n", "skip", "prefix")]
            for row in zip(*cols):
                if row[:3] != group:
                    if held:
                        yield pairs()
                    group, held = row[:3], []
                held.append(row[3:])
        if held:
            yield pairs()

    return (
        rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
        .mapInArrow(compare, "x bigint, y bigint").distinct())


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id, kept) of every document."""
    prepare(docs.sparkSession)
    every = stored(sketches(docs, id_col, text_col, k), "sketches")
    reps = stored(
        every.where("n > 0 AND doc_id IS NOT NULL").groupBy("f1", "f2").agg(
            F.min("doc_id").alias("rep"), F.first("half").alias("half"), F.first("sig").alias("sig")),
        "classes")
    keys = stored(table_keys(reps), "table-keys")
    buckets = stored(
        keys.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"),
                                F.count(F.lit(1)).alias("c")).where("lo < hi"), "buckets")
    near = keys.join(sized(buckets), "key")
    stars = stored(_ordered(near, "rep", "lo").union(_ordered(near, "rep", "hi")).distinct(), "stars")
    links = confirmed(stored(_agreeing(stars, reps), "pairs"), docs, id_col, text_col, k, percent)
    comps = stored(components(links), "components")
    across = stored(
        _across(keys, buckets, comps, reps, docs, id_col, text_col, k, percent).join(stars, ["x", "y"], "left_anti"), "across")
    if not across.isEmpty():
        links = links.union(confirmed(across, docs, id_col, text_col, k, percent))
        comps = stored(components(links), "components")
    classes = reps.select("f1", "f2", "rep")
    named = (
        every.select("doc_id", "n", "f1", "f2").join(sized(classes), ["f1", "f2"], "left")
        .join(sized(comps.withColumnRenamed("node", "rep")), "rep", "left"))
    linked = "doc_id IS NOT NULL AND n > 0"
    return named.selectExpr(
        "doc_id", "n AS n_shingles", f"if({linked}, rep, doc_id) AS class_id",
        f"if({linked}, coalesce(component, rep), doc_id) AS component_id",
    ).withColumn("kept", F.expr("coalesce(doc_id = component_id, true)"))


def keep_one(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Documents without the near-duplicates of an earlier id."""
    gone = stored(
        near_duplicates(docs, k, percent).where("NOT kept").select("doc_id").distinct(), "near-copies")
    return docs.join(sized(gone), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Contract query: four-word shingles, similarity of 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=4).drop("class_id")


_LOWER = "translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format(c="coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + least(4, len(w)) - 1], ' ') AS sh
  FROM w, unnest(generate_series(1, len(w) - least(4, len(w)) + 1)) AS t(p) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), i AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 80 * (a.n + b.n - i)
), r AS (
  SELECT doc_id AS node, doc_id AS reach FROM n
  UNION SELECT r.node, l.y FROM r JOIN l ON l.x = r.reach
), c AS (SELECT node, min(reach) AS component FROM r GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component, w.doc_id) AS component_id,
  coalesce(component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = w.doc_id
"""
