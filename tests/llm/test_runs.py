"""Periodic runs against trying every period."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from casekit.llm import runs
from tests.llm import tables


def slow_runs(s, least, exponent):
    """All maximal stretches of each period whose smallest period it is."""
    n, out = len(s), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j + q - i
            smallest = next(p for p in range(1, q + 1)
                            if all(s[k] == s[k + p] for k in range(i, i + length - p)))
            if smallest == q and length >= max(least, exponent * q):
                out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_every_run_of_small_alphabets(s):
    a = np.array(s, dtype=np.int64)
    assert [tuple(r) for r in runs.all_runs(a).tolist()] == sorted(slow_runs(s, 2, 2))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 9)), max_size=8))
def test_long_runs_of_repeated_blocks(blocks):
    s = [x for part, times in blocks for x in part * times]
    a = np.array(s, dtype=np.int64)
    assert [tuple(r) for r in runs.long_runs(a).tolist()] == slow_runs(s, 6, 4)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10_000), st.integers(2, 60))
def test_extensions_equal_direct_comparison(seed, n):
    rng = np.random.default_rng(seed)
    s = rng.integers(1, 4, n)
    tree = runs.SuffixTree(s)
    i, j = rng.integers(0, n, 50), rng.integers(0, n, 50)
    i, j = i[i != j], j[i != j]
    for a, b, got in zip(i, j, tree.common(i, j)):
        k = 0
        while max(a, b) + k < n and s[a + k] == s[b + k]:
            k += 1
        assert got == k
    suffixes = sorted(range(n + 1), key=lambda k: s[k:].tolist())
    assert np.argsort(tree.rank).tolist() == suffixes
    inverse = sorted(range(n + 1), key=lambda k: (-s[k:]).tolist())
    assert np.argsort(tree.inverse_rank).tolist() == inverse


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = slow_runs(words, 6, 4)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in drop)))


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_awkward_documents(spark, awkward):
    got = [tuple(r[c] for c in COLUMNS) for r in entry.queries()["op12_periodic_runs"](spark, awkward).collect()]
    docs = [d for d in tables.documents() if len(d["text"] or "") < 50_000]
    small = {str(d["doc_id"]) for d in docs}
    want = [expected(d["doc_id"], d["text"]) for d in docs]
    assert sorted(map(str, (g for g in got if str(g[0]) in small))) == sorted(map(str, want))
    assert len(got) == len(tables.documents())


def test_a_small_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r[c] for c in COLUMNS) for r in entry.queries()["op12_periodic_runs"](spark, sf).collect()]
    assert len(got) == len(docs)
    small = [d for d in docs if len((d.text or "").split()) <= 700]
    ids = {d.doc_id for d in small}
    assert len(small) > 0.7 * len(docs)
    assert sorted(g for g in got if g[0] in ids) == sorted(expected(d.doc_id, d.text) for d in small)
    assert sum(g[1] > 0 for g in got) >= 5


def test_long_texts_and_texts_of_one_word(spark):
    rows = [(1, "a " * 100_000), (2, " ".join(f"w{i % 500}" for i in range(60_000))), (3, "x y x y x y x"),
            (4, "x y x y x y x y"), (5, "a\u00a0b\x0ba\u00a0b\x0ca\u00a0b a\u00a0b a\u00a0b a\u00a0b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in runs.periodic_runs(df).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 100_000, 1)] and got[1].collapsed == "a"
    assert [tuple(x) for x in got[2].runs] == [(0, 60_000, 500)] and len(got[2].collapsed.split()) == 500
    assert not got[3].runs and got[3].collapsed == rows[2][1]
    assert [tuple(x) for x in got[4].runs] == [(0, 8, 2)] and got[4].collapsed == "x y"
    assert [tuple(x) for x in got[5].runs] == [(0, 6, 1)]  # a no-break space is no separator
