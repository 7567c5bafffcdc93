"""Token shards: exact round trip, permutation, resumed reads."""

from __future__ import annotations

import collections

import numpy as np
import pytest

from casekit.llm import tokens
from casekit.plans.pipeline import scratch_path
from tests.llm import tables


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 1000, 4097])
def test_feistel_is_a_permutation(n):
    out = tokens.Feistel(n, 9)(np.arange(n))
    assert sorted(out.tolist()) == list(range(n))


def test_keys_give_different_orders():
    a, b = (tokens.Feistel(5000, k)(np.arange(5000)) for k in (1, 2))
    assert (a != b).mean() > 0.9 and (a != np.arange(5000)).mean() > 0.9


def test_cached_words_give_the_tokenizers_ids():
    t = tokens.tokenizer(tokens.TOKENIZER)
    for text in ["", " ", "a", " a  b", "Hello, world's  end.\n\n x", "é ü\t z ", "a\nb c", "<|endoftext|> x", "日本 語"]:
        assert t.encode(text) == t.ids(text)


def test_texts_leave_no_words_in_the_worker():
    """A worker's memory must not follow the number of distinct words."""
    t = tokens.Tokenizer(tokens.TOKENIZER)
    text = " ".join(f"w{i}x" for i in range(20_000))
    assert len(t.encode(text)) > 40_000 and len(t) == 0
    assert t["w1x"] == t.ids(" w1x") and len(t) == 1  # single words are kept, for op5


def test_words_at_once_have_the_ids_of_single_words():
    t = tokens.Tokenizer(tokens.TOKENIZER)
    words = ["the", "thorrenly", "'s", "don't", "12ab!", "\x00", "\x1c", "\u00a0", "a\u00a0", "\u3000b", "c\u0085d",
             "\u00e9t\u00e9", "\ufffd", "\u65e5\u672c", "x" * 5000, "--'re", "\u2028\u2028", "z"]
    for some in (words, words[::-1], words[:1], [words[7]], []):
        ids, n = t.words("".join(" " + w for w in some))
        cut = np.split(ids, np.cumsum(n)[:-1]) if some else []
        assert [x.tobytes() for x in cut] == [t.ids(" " + w) for w in some]
    assert len(t) == 0  # none is kept


def test_round_trip_and_resume(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    out = scratch_path(spark, "shards")
    assert tokens.write_shards(docs, out, seq_len=64, shard_span=300)
    rows = tokens.read_slots(spark, out, 0, None, 64).collect()
    total = len(rows)
    assert sorted(r.slot for r in rows) == list(range(total))
    shards = [r.shard for r in sorted(rows)]
    assert shards == sorted(shards) and len(set(shards)) > 5
    t = tokens.tokenizer(tokens.TOKENIZER)
    want = collections.Counter()
    for d in tables.documents():
        ids = t.bpe.encode_ordinary(d["text"] or "") + [tokens.END_ID]
        for i in range(0, len(ids), 64):
            want[(d["doc_id"], i // 64, tuple(ids[i:i + 64]))] += 1
    got = collections.Counter((r.doc_id, r.seq_no, tuple(np.frombuffer(r.ids, "<u2").tolist())) for r in rows)
    assert got == want
    first = total // 3
    rest = tokens.read_slots(spark, out, first, total - 5, 64).collect()
    assert sorted(rest) == sorted(r for r in rows if first <= r.slot < total - 5)


def test_same_slots_in_any_partitioning(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    results = []
    try:
        for size in ("128MB", "10KB"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            results.append(sorted(map(str, tokens.materialise(docs, seq_len=64).collect())))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert results[0] == results[1]


def test_a_task_writes_several_shards(spark, awkward, monkeypatch):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    results = []
    for task_bytes in (1, 1 << 20):
        monkeypatch.setattr(tokens, "TASK_BYTES", task_bytes)
        out = scratch_path(spark, "shards")
        assert tokens.write_shards(docs, out, seq_len=64, shard_span=300)
        results.append(sorted(map(str, tokens.read_slots(spark, out, 0, None, 64).collect())))
    assert results[0] == results[1]
