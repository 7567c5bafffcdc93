"""Budgets down the tree against a direct recursion."""

from __future__ import annotations

from fractions import Fraction

from casekit.llm import mixing


def split(budget: int, children: dict) -> dict:
    """children: name -> (capacity, weight).  Fill up, share the rest, repeat."""
    full: dict = {}
    while True:
        left = budget - sum(full.values())
        weight = sum(w for n, (_, w) in children.items() if n not in full)
        over = {n: c for n, (c, w) in children.items()
                if n not in full and Fraction(c) * weight <= Fraction(left) * w}
        if not over:
            return {n: full[n] if n in full else left * w // weight for n, (c, w) in children.items()}
        full.update(over)


def test_budgets_equal_the_recursion(spark):
    leaves = [("web", "en", f"s{i}", 100 * (i + 1)) for i in range(5)] + [
        ("web", "de", "a", 40), ("web", "de", "b", 5), ("books", "en", "c", 10), ("news", "fr", "d", 3000),
        ("forum", "es", "e", 7), ("forum", "es", "f", 0)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint")
    for percent in (10, 60, 100, 190):
        got = {(r.domain, r.lang, r.source): r.budget
               for r in mixing.leaf_budgets(df, percent, 2).collect()}
        total = sum(t for *_, t in leaves)
        w_domain = {"web": 4, "books": 3, "news": 2, "forum": 1}
        w_lang = {"en": 5, "de": 2, "fr": 2, "es": 1}
        cap = lambda *k: 2 * sum(t for *p, t in leaves if tuple(p[:len(k)]) == k)
        want = {}
        for d, b in split(min(total * percent // 100, 2 * total),
                          {d: (cap(d), w_domain[d]) for d in {x[0] for x in leaves}}).items():
            for la, c in split(b, {x[1]: (cap(d, x[1]), w_lang[x[1]]) for x in leaves if x[0] == d}).items():
                want.update({(d, la, s): v for s, v in split(
                    c, {x[2]: (cap(*x[:3]), 1) for x in leaves if x[:2] == (d, la)}).items()})
        assert got == want
        assert sum(got.values()) <= total * percent // 100


def test_a_leafs_prefix_is_cut_exactly(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    plan = mixing.mixture_plan(docs)
    by_leaf = {tuple(r[c] for c in mixing.TREE): r for r in plan.collect()}
    taken = {}
    for r in mixing.mix(docs).collect():
        leaf = tuple(r[c] for c in mixing.TREE)
        taken[leaf] = taken.get(leaf, 0) + r.tokens_taken
    assert {k: r.budget for k, r in by_leaf.items() if r.budget} == taken
    assert any(r.full_epochs == 2 for r in by_leaf.values()) and any(r.cut_key for r in by_leaf.values())


def test_stage_keeps_columns_and_takes_the_same_documents(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    plan = mixing.mixture_plan(docs, percent=80, max_epochs=1)
    kept = mixing.select(docs, plan)
    assert kept.columns == docs.columns
    units = mixing.taken(mixing.leaf_tokens(docs), plan).where("tokens_taken > 0")
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, (r.doc_id for r in units.collect())))


def test_a_third_of_a_leaf_on_one_id(spark, tmp_path):
    """The budget is kept, in the query's rows and in the stage, whatever row it ends in."""
    path = str(tmp_path / "docs")
    spark.range(0, 3000, 1, 7).selectExpr(
        "if(id % 3 = 0, 7, id) AS doc_id", "concat(repeat('w ', cast(1 + id % 4 as int)), id) AS text",
        "'en' AS lang", "'one' AS source").write.parquet(path)
    docs = spark.read.parquet(path)
    for percent, epochs in ((30, 1), (55, 1), (130, 2)):
        plan = mixing.mixture_plan(docs, percent=percent, max_epochs=epochs)
        row = plan.first()
        rows = mixing.mix(docs, percent=percent, max_epochs=epochs).collect()
        assert sum(r.tokens_taken for r in rows) == row.budget
        assert sum(0 < r.cut_part < r.n_tokens for r in rows) <= 1
        kept = mixing.select(docs, plan).select("doc_id", "text").collect()
        assert sorted((r.doc_id, len(r.text.split())) for r in kept) == sorted((r.doc_id, r.n_tokens) for r in rows)
        assert epochs == 2 or len({r.text for r in kept}) == len(kept)
    key = mixing._key(mixing.SEED, "0", "doc_id")
    at = docs.selectExpr("doc_id", f"{key} AS k", "size(split(trim(text), ' ')) AS n").collect()
    below = sum(r.n for r in at if r.k < next(x.k for x in at if x.doc_id == 7))
    total = sum(r.n for r in at)
    percent = 100 * (below + sum(r.n for r in at if r.doc_id == 7) // 2) // total
    rows = mixing.mix(docs, percent=percent, max_epochs=1).collect()
    assert 0 < sum(r.doc_id == 7 for r in rows) < 1000  # the budget ends inside the hot id
    assert sum(r.tokens_taken for r in rows) == total * percent // 100
