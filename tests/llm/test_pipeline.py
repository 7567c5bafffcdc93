"""The pipeline's stages against brute force on their own inputs."""

from __future__ import annotations

import collections

import corpus_pipeline
from casekit.llm import mixing, tokens
from casekit.llm.common import stored, table
from tests.llm import test_decontaminate as dc
from tests.llm import test_neardup as nd
from tools.oracle_check import duck_for

SF = "/root/testdata/sf0.001"


def test_every_stage(spark):
    inputs, docs = {}, table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = stored(stage(spark, docs, SF), "stage")
    ids = {n: {r.doc_id: r.text for r in d.select("doc_id", "text").collect()} for n, d in inputs.items()}
    for name, d in inputs.items():
        assert d.columns == columns, name
    # language ID: real prose stays
    assert len(ids["near_dedup"]) >= 0.98 * len(ids["language_id"])
    # near-dedup: the smallest id of every component
    want = {d for d, (_, c) in nd.brute(list(ids["near_dedup"].items()), 5).items() if d == c}
    assert set(ids["decontaminate"]) == want and len(want) < len(ids["near_dedup"])
    # decontamination
    items = [(str(r.item_id), r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = set()
    windows = {tuple(w[i:i + 13]) for _, t in items for w in [dc.words_of(t)] for i in range(len(w) - 12)}
    assert all(len(dc.words_of(t)) >= 13 for _, t in items)
    for d, t in ids["decontaminate"].items():
        w = dc.words_of(t)
        hit = {q for p in range(len(w) - 12) if tuple(w[p:p + 13]) in windows for q in range(p, p + 13)}
        if not (hit and 20 * len(hit) >= len(w)):
            clean.add(d)
    assert set(ids["mixing"]) == clean and clean != set(ids["decontaminate"])
    # mixing: the SQL of the operator, over the stage's input and its budget
    con = duck_for(SF)
    con.register("stage_docs", inputs["mixing"].toPandas())
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM stage_docs")
    sql = mixing.ORACLE.replace(f"* {mixing.PERCENT} // 100", f"* {corpus_pipeline.MIX_PERCENT} // 100")
    sql = sql.replace(f"sum(tokens) * {mixing.MAX_EPOCHS})", "sum(tokens))")
    sql = sql.replace(f"::HUGEINT * {mixing.MAX_EPOCHS} AS cap", "::HUGEINT AS cap")
    assert set(ids["token_shards"]) == set(con.execute(sql).df().doc_id) != clean
    # token shards: every sequence of every document, once
    t = tokens.tokenizer(tokens.TOKENIZER)
    want = collections.Counter()
    for d, text in ids["token_shards"].items():
        n = len(t.bpe.encode_ordinary(text)) + 1
        want.update((d, i, min(tokens.SEQ_LEN, n - i * tokens.SEQ_LEN)) for i in range(-(-n // tokens.SEQ_LEN)))
    rows = docs.collect()
    assert collections.Counter((r.doc_id, r.seq_no, r.n_tokens) for r in rows) == want
    assert sorted(r.slot for r in rows) == list(range(len(rows)))


def test_empty_and_awkward_documents(spark, empty, awkward):
    assert corpus_pipeline.run(spark, empty).count() == 0
    rows = corpus_pipeline.run(spark, awkward).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows))) and rows
