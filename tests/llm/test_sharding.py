"""Sharding against brute force."""

from __future__ import annotations

import zlib

import __spark_entry__ as entry
from casekit.llm import sharding
from casekit.plans.pipeline import scratch_path
from tests.llm import tables


def check(got, docs, shards=40):
    want = sorted((str(d["doc_id"]), len((d["text"] or "").encode()) + 16, zlib.crc32((d["text"] or "").encode()))
                  for d in docs)
    ids = [str(int(x)) if x == x else "None" for x in got.doc_id.astype(float)]
    assert sorted(zip(ids, got["size"], got.text_crc32)) == want
    assert got.shard.between(0, shards - 1).all() and got.grown_shard.isna().all()
    assert set(got.law) == {"bytes"}
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_awkward_documents(spark, awkward):
    check(entry.queries()["op10_sharding"](spark, awkward).toPandas(), tables.documents())


def test_sizes_are_near_equal(spark):
    sf = "/root/testdata/sf0.01"
    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op10_sharding"](spark, sf).toPandas()
    check(got, docs)
    load = got.groupby("shard")["size"].sum()
    assert load.max() - load.min() <= 0.02 * load.mean() + 1


def test_one_text_in_a_third_of_all_rows_spreads(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same', concat('t', id)) AS text")
    got = sharding.shard_documents(docs, 40).where("text_crc32 = crc32('same')").groupBy("shard").count().collect()
    assert len(got) == 40 and max(r["count"] for r in got) < 2 * 10_000 / 40


def test_initial_map_is_greedy(spark):
    sizes = [50, 40, 30, 30, 20, 10, 5]
    slots = spark.createDataFrame([(i, b, 1) for i, b in enumerate(sizes)], "vslot bigint, bytes bigint, n bigint")
    load, want = [0, 0, 0], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        s = load.index(min(load))
        want[i] = s
        load[s] += sizes[i]
    assert {r.vslot: r.shard for r in sharding.initial_map(slots, 3).collect()} == want


def test_a_new_shard_only_takes(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    recs = sharding.records(docs)
    path = scratch_path(spark, "map")
    before = sharding.initial_map(sharding.slot_bytes(recs), 6)
    sharding.store_map(before, path)
    sharding.store_map(sharding.add_shard(sharding.latest_map(spark, path), 6), path)
    old = {r.vslot: r.shard for r in before.collect()}
    new = sharding.latest_map(spark, path).collect()
    assert {r.version for r in new} == {1} and {r.vslot for r in new} == set(old)
    moved = [r for r in new if r.shard != old[r.vslot]]
    assert moved and all(r.shard == 6 for r in moved)
    assert spark.read.parquet(path).selectExpr("count(distinct version)").first()[0] == 2


def test_the_query_gives_the_next_version_of_the_map(spark):
    got = entry.queries()["op10_sharding"](spark, "/root/testdata/sf0.01").toPandas()
    assert got.shard.between(0, 39).all() and got.rebalanced_shard.between(0, 40).all()
    moved = got[got["shard"] != got.rebalanced_shard]
    assert len(moved) and (moved.rebalanced_shard == 40).all()
    assert (got.groupby("vslot").rebalanced_shard.nunique() == 1).all()
    fair = got["size"].sum() / 41
    old, new = (got.groupby(c)["size"].sum() for c in ("shard", "rebalanced_shard"))
    assert (new.drop(40) >= old.clip(upper=fair) - 1).all()  # none gives below the fair share


def moved_map(spark, sizes, shards):
    """Slots (bytes, shard) before and after one more shard."""
    slots = spark.createDataFrame(
        [(0, i, sh, b, 1) for i, (b, sh) in enumerate(sizes)], sharding.MAP)
    return {r.vslot: r.shard for r in sharding.add_shard(slots, shards).collect()}


def loads(sizes, where, shards):
    out = [0] * (shards + 1)
    for i, (b, _) in enumerate(sizes):
        out[where[i]] += b
    return out


def test_a_giant_slot_does_not_starve_the_new_shard(spark):
    sizes = [(216_140, 5)] + [(150 + 7 * i % 90, i % 5) for i in range(250)]
    new = moved_map(spark, sizes, 6)
    old, now = loads(sizes, [s for _, s in sizes], 6), loads(sizes, new, 6)
    assert all(new[i] in (s, 6) for i, (_, s) in enumerate(sizes)) and new[0] == 5
    fair = sum(b for b, _ in sizes[1:]) / 6
    assert 0.97 * fair <= now[6] <= fair and all(fair <= x <= y for x, y in zip(now[:5], old))


def test_coarse_slots_still_fill_the_new_shard(spark):
    sizes = [(100, i // 2) for i in range(8)]  # two slots of 100 in each of four shards
    assert loads(sizes, moved_map(spark, sizes, 4), 4) == [100, 200, 200, 200, 100]
    one_each = [(100, 0), (90, 1)]
    assert loads(one_each, moved_map(spark, one_each, 2), 2) == [100, 90, 0]  # nothing to gain


def test_a_third_of_all_rows_on_one_id(spark):
    docs = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 5, id) AS doc_id", "if(id % 9 = 0, 'same', repeat(concat('t', id), 3)) AS text")
    got = sharding.shard_documents(docs, 40).toPandas()
    assert len(got) == 30_000
    load = got.groupby("shard")["size"].sum()
    assert load.max() - load.min() <= 0.02 * load.mean()
    new = got.groupby("rebalanced_shard")["size"].sum()
    assert (got["shard"] != got.rebalanced_shard).any() and new[40] >= 0.95 * new.mean()
    assert all(sorted(p.slot) == list(range(len(p))) for _, p in got.groupby("shard"))
