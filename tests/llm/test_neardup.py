"""Near-duplicates against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from casekit.llm import neardup
from casekit.llm.components import components


def shingles(text: str | None, k: int) -> set:
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs: list[tuple[int, str | None]], k: int) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_group(rng: random.Random, n: int, words: int, changes: int) -> list[str]:
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        copy = list(base)
        for _ in range(rng.randrange(changes + 1)):
            copy[rng.randrange(words)] = f"y{rng.randrange(5000)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("block", [1024, 8])
def test_components_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(4)
    texts: list[str | None] = near_group(rng, 120, 60, 3) + near_group(rng, 30, 200, 8)
    texts += near_group(rng, 3, 40, 1) + [None, "", "one", "one", "One two", "one two three four"] * 2
    texts += [" ".join(f"z{rng.randrange(900)}" for _ in range(80)) for _ in range(40)]
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"q{rng.randrange(9000)}" for _ in range(40)) for _ in range(40)]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, k=4).collect()}
    assert got == brute(docs, 4)


def test_shingle_sets_are_exact():
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 1, 3, 4, 5, 50, 300)]
    for k in (4, 5):
        s = neardup.sketch([t.encode() for t in texts], k)
        assert s["n"].tolist() == [len(shingles(t, k)) for t in texts]


def test_sketch_agreement_follows_similarity():
    rng = random.Random(2)
    a = [f"w{i}" for i in range(400)]
    b = a[:320] + [f"v{rng.randrange(9999)}" for _ in range(60)]
    s = neardup.sketch([" ".join(a).encode(), " ".join(b).encode()], 1)
    truth = 320 / (400 + 380 - 320)
    assert abs((s["sig"][0] == s["sig"][1]).mean() - truth) < 0.2


def test_recall_of_the_tables():
    """A pair at the threshold misses every table less than once in a thousand."""
    row = 0.8 ** neardup.ROWS
    assert 1 - (1 - (1 - row) ** neardup.HALVES) ** 2 < 1e-3


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(1)
    chain = [(int(a), int(a) + 1) for a in rng.permutation(60)]
    star = [(500, 100 + i) for i in range(80)]
    links = chain + star + [(900, 900), (None, 3)]
    df = spark.createDataFrame(links, "x bigint, y bigint")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(80)}, 500: 100}


def test_one_of_each_group_stays(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.dropDuplicates(["doc_id"]).collect() if r.doc_id is not None]
    want = {d for d, (_, c) in brute(rows, 5).items() if d == c}
    assert {r.doc_id for r in kept.collect()} - {None} == want
