"""Wu-Manber search against looking at every position."""

from __future__ import annotations

import random
import re

from casekit.llm import decontaminate as dc
from casekit.llm.common import NON_ALNUM, SPACES, Words

RULE = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text: str) -> list[str]:
    return RULE.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def brute(text: str, items: list[tuple[str, str]]) -> tuple[int, set[int], list[str]]:
    w = words_of(text)
    hit, names = set(), set()
    for name, body in items:
        b = words_of(body)
        m = min(dc.WINDOW, len(b))
        for s in range(len(b) - m + 1 if m else 0):
            for p in range(len(w) - m + 1):
                if w[p:p + m] == b[s:s + m]:
                    hit |= set(range(p, p + m))
                    names.add(name)
    return len(w), hit, sorted(names)


def test_words_follow_the_rule():
    text = "Ab-c D1_é\tü?x\x00y ÀB's 日本語 z\x7fq"
    got = Words([text.encode(), b"", b" ", text.encode()], NON_ALNUM)
    assert [got.word(i).decode() for i in range(got.first[0], got.first[1])] == words_of(text)
    assert got.first.tolist() == [0, len(words_of(text))] + [len(words_of(text))] * 2 + [2 * len(words_of(text))]
    assert (got.hash[:got.first[1]] == got.hash[got.first[3]:]).all()


def test_equal_words_hash_alike_wherever_they_stand():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "bb", "ccc", "Bb", "é"]) for _ in range(200_000))]
    w = Words([t.encode() for t in texts], SPACES)
    by_word: dict[bytes, set[int]] = {}
    for i in range(0, len(w.hash), 997):
        by_word.setdefault(w.word(i), set()).add(int(w.hash[i]))
    assert all(len(v) == 1 for v in by_word.values())
    assert len({next(iter(v)) for v in by_word.values()}) == len(by_word) == 4


def test_search_equals_brute_force():
    rng = random.Random(11)
    letters = ["a", "b", "c", "d"]  # a small alphabet makes many near misses
    for _ in range(30):
        texts = [" ".join(rng.choice(letters) for _ in range(rng.choice([0, 3, 14, 60, 400]))) for _ in range(6)]
        items = []
        for i in range(8):
            source = rng.choice(texts).split()
            n = rng.choice([0, 1, 2, 5, 12, 13, 14, 20])
            s = rng.randrange(max(1, len(source) - n))
            items.append((str(i), " ".join(source[s:s + n])))
        found = dc.Matcher([(n, b.encode()) for n, b in items]).search([t.encode() for t in texts])
        for text, row in zip(texts, found):
            n, hit, names = brute(text, items)
            assert row["n_words"] == n and row["items"] == names
            assert {p for s in row["spans"] for p in range(s["lo"], s["hi"])} == hit


def test_several_benchmark_blocks_give_the_same(spark, awkward):
    from pyspark.sql import functions as F

    from casekit.llm.common import table

    docs, bench = table(spark, awkward, "documents"), table(spark, awkward, "benchmark")
    results = []
    for size in (dc.BLOCK_BYTES, 100):
        h = dc.hits(spark, bench, F.col("text"), block_bytes=size)
        results.append(sorted(map(str, docs.select("doc_id", h.alias("h")).selectExpr(
            "doc_id", "h.n_words", "h.n_hit", "h.items").collect())))
    assert len(list(dc.benchmark_blocks(bench, block_bytes=100))) > 1
    assert results[0] == results[1]


def test_clean_documents_stay(spark, awkward):
    from casekit.llm.common import table

    docs = table(spark, awkward, "documents")
    kept = dc.remove_contaminated(docs, table(spark, awkward, "benchmark"))
    assert kept.columns == docs.columns
    items = [(str(r.item_id), r.text) for r in table(spark, awkward, "benchmark").collect()
             if r.item_id is not None and r.text]
    want = []
    for r in docs.collect():
        n, hit, _ = brute(r.text[:50_000] if r.text and len(r.text) > 60_000 else r.text or "", items)
        if r.text and len(r.text) > 60_000:
            continue
        if not (hit and 20 * len(hit) >= n):
            want.append(r.doc_id)
    got = [r.doc_id for r in kept.collect() if not (r.text and len(r.text) > 60_000)]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_passes_over_blocks_equal_one_pass(spark, awkward):
    from casekit.llm.common import table

    docs, bench = table(spark, awkward, "documents"), table(spark, awkward, "benchmark")
    results = []
    for size in (dc.BLOCK_BYTES, 60):
        rows = dc.with_hits(docs, bench, block_bytes=size).selectExpr(
            "doc.doc_id", "doc.text", "h.n_words", "h.n_hit", "h.spans", "h.items").collect()
        hit = [{p for s in r.spans for p in range(s.lo, s.hi)} for r in rows]
        assert all(len(words) == r.n_hit for words, r in zip(hit, rows))
        results.append(sorted(str((r.doc_id, r.text, r.n_words, sorted(words), r["items"]))
                              for words, r in zip(hit, rows)))
    assert results[0] == results[1] and len(results[0]) == docs.count()
    assert dc.benchmark_tables(bench, block_bytes=60).count() > 5


def test_long_and_repeated_items_are_dealt_in_pieces(spark):
    n = 3 * dc.PIECE_WINDOWS + 5
    long = " ".join(f"w{i}" for i in range(n))
    bench = spark.createDataFrame(
        [("long", long)] * 40 + [("long", f"other text {i}") for i in range(40)] + [("short", "Two words")],
        "item_id string, text string")
    edge = dc.PIECE_WINDOWS  # a passage over the border of two pieces
    docs = spark.createDataFrame(
        [(1, " ".join(f"W{i}" for i in range(edge - 20, edge + 30))), (2, long), (3, "two, words and other text 7"),
         (4, " ".join(f"w{i}" for i in range(edge, edge + 12))), (5, None)], "doc_id bigint, text string")
    want = [(1, 50, 50, ["long"]), (2, n, n, ["long"]), (3, 6, 5, ["long", "short"]), (4, 12, 0, []), (5, 0, 0, [])]
    for size in (dc.BLOCK_BYTES, 20_000):
        tables = dc.benchmark_tables(bench, block_bytes=size)
        got = dc.with_hits(docs, bench, block_bytes=size).selectExpr(
            "doc.doc_id", "h.n_words", "h.n_hit", "h.items").collect()
        assert sorted(map(tuple, got)) == want
    # Repeated rows of an item are searched for once, and no block has them all.
    sizes = [len(r.matcher) for r in tables.select("matcher").collect()]
    assert len(sizes) > 1


def test_rows_with_any_column_names_pass_through_blocks(spark):
    docs = spark.createDataFrame([("a b", 1, 2, 3), ("x", 4, 5, 6), ("x", 4, 5, 6)],
                                 "text string, row int, body int, h int")
    bench = spark.createDataFrame([("i", "a b"), ("j", "q r s"), ("k", "t u v")], "item_id string, text string")
    got = dc.with_hits(docs, bench, block_bytes=3).selectExpr("doc.*", "h.n_hit AS hit").collect()
    assert sorted(map(tuple, got)) == [("a b", 1, 2, 3, 2), ("x", 4, 5, 6, 0), ("x", 4, 5, 6, 0)]
