"""Operator 7: mixing sources to target weights (DataFrame / SQL only).

Leaves are (domain, lang, source).  A token budget flows down the tree: at
every node it is split over the children in proportion to their weights; a
child that cannot use its part (its subtree holds too few tokens, even over
``max_epochs``) keeps its capacity and the rest goes to its siblings.  Because
a node never gets more than its subtree can hold, a shortage reaches the
ancestors' other children only when all siblings are full.

A leaf's stream is epoch 0, epoch 1, ... of its documents, each epoch in its
own seeded order; the leaf takes the first ``budget`` tokens of that stream.
The cut is found by narrowing two bytes of the order key at a time over
partial sums, so no task ever sorts a whole leaf, however hot.  Rows of equal
key (repeated ids) are ordered by their tokens; rows equal in both are
interchangeable and are numbered, task by task, only where the cut falls.

Defined results: null lang or source counts as the empty string.  A null or
empty text has no tokens and is never taken.  Rows with equal doc_id in one
leaf share their order key and are separate documents: the budget ends inside
one of them.  An empty table gives an
empty result.  Integer division may leave up to one token per child unused.
Extra columns are kept by ``select`` and ignored by the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casekit.llm.common import sized, stored, table

TREE = ["domain", "lang", "source"]
SEED = 17

# documents carry no domain; sources are dealt to four domains by hash.  A
# deployment passes its own source-to-domain expression.
DOMAIN = ("CASE WHEN substr(md5({source}), 1, 1) < '4' THEN 'web' "
          "WHEN substr(md5({source}), 1, 1) < '8' THEN 'books' "
          "WHEN substr(md5({source}), 1, 1) < 'c' THEN 'news' ELSE 'forum' END")
# Integer weight of a child among its siblings, by tree level.
WEIGHTS = {
    "domain": "CASE domain WHEN 'web' THEN 4 WHEN 'books' THEN 3 WHEN 'news' THEN 2 ELSE 1 END",
    "lang": "CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END",
    "source": "1",
}
TOKENS = r"coalesce(regexp_count({text}, '[^\\x20\\x09-\\x0D]+'), 0)"
PERCENT = 60
MAX_EPOCHS = 2


def _leaf_columns(docs: DataFrame, domain: str) -> dict[str, str]:
    source = "coalesce(`source`, '')"
    return {"domain": domain.format(source=source), "lang": "coalesce(`lang`, '')",
            "source": source}


def leaf_tokens(docs: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens) of every document."""
    cols = _leaf_columns(docs, domain)
    return docs.selectExpr(
        "doc_id", *[f"{e} AS {n}" for n, e in cols.items()],
        f"cast({TOKENS.format(text='`text`')} as bigint) AS n_tokens")


def split_budget(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Split ``parent_budget`` over the children of each parent.

    ``children`` has the parent keys, ``child``, ``cap``, ``w`` and
    ``parent_budget``.  In order of cap / w the children that fill up come
    first; the others share what is left by weight.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.expr("cast(cap as double) / w"), child)
    d = "decimal(38,0)"
    return (
        children
        .withColumn("__before", F.coalesce(
            F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("__w", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("__full", F.expr(
            f"cast(cap as {d}) * __w <= cast(parent_budget - __before as {d}) * w"))
        .withColumn("__left", F.col("parent_budget") - F.sum(
            F.expr("if(__full, cap, 0)")).over(by))
        .withColumn("__open", F.sum(F.expr("if(__full, 0, w)")).over(by))
        .withColumn("budget", F.expr(
            f"if(__full, cap, cast(cast(__left as {d}) * w div nullif(__open, 0) as bigint))"))
        .drop("__before", "__w", "__full", "__left", "__open")
    )


def leaf_budgets(leaves: DataFrame, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS,
                 weights: dict[str, str] | None = None) -> DataFrame:
    """Budget of every leaf; ``leaves`` has TREE and ``tokens``."""
    weights = weights or WEIGHTS
    parents = leaves.agg(F.sum("tokens").alias("__all")).selectExpr(
        f"least(__all * {percent} div 100, __all * {max_epochs}) AS parent_budget")
    for depth, level in enumerate(TREE):
        keys = TREE[:depth + 1]
        nodes = leaves.groupBy(*keys).agg((F.sum("tokens") * max_epochs).alias("cap"))
        if depth == 0:
            nodes = nodes.withColumn("__one", F.lit(1)).join(
                parents.withColumn("__one", F.lit(1)), "__one").drop("__one")
        else:
            nodes = nodes.join(parents, TREE[:depth])
        nodes = nodes.withColumn("w", F.expr(weights[level]).cast("bigint"))
        nodes = split_budget(nodes, TREE[:depth], level)
        parents = nodes.select(*keys, F.col("budget").alias("parent_budget"))
    return leaves.join(parents.withColumnRenamed("parent_budget", "budget"), TREE)


def _narrow(units: DataFrame, start: int) -> DataFrame:
    """The group of order keys that holds each leaf's cut, and tokens before it."""
    groups = (
        units.withColumn("__p", F.expr(f"substr(key, {start}, 2)"))
        .groupBy(*TREE, "rem", "before", "__p").agg(F.sum("n_tokens").alias("s"))
    )
    w = Window.partitionBy(*TREE).orderBy("__p")
    return (
        groups.withColumn("__upto", F.col("before") + F.sum("s").over(w))
        .where("__upto - s < rem AND rem <= __upto")
        .select(*TREE, "__p", (F.col("__upto") - F.col("s")).alias("__before"))
    )


def mixture_plan(docs: DataFrame, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS,
                 weights: dict[str, str] | None = None, domain: str = DOMAIN,
                 seed: int = SEED) -> DataFrame:
    """One row per leaf: tokens, budget, whole epochs and the cut of the last.

    ``cut_key`` and ``cut_n`` are the order key and the tokens of the rows the
    budget ends in, and ``cut_tokens`` how many tokens of them, one row after
    the other, belong to the prefix.
    """
    return plan_of(stored(leaf_tokens(docs, domain), "mix-units"), percent, max_epochs, weights, seed)


def plan_of(units: DataFrame, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS,
            weights: dict[str, str] | None = None, seed: int = SEED) -> DataFrame:
    """The plan (see ``mixture_plan``) of stored units."""
    leaves = units.groupBy(*TREE).agg(F.sum("n_tokens").alias("tokens"))
    plan = leaf_budgets(stored(leaves, "mix-leaves"), percent, max_epochs, weights)
    plan = stored(plan.selectExpr(
        *TREE, "tokens", "budget",
        "cast(coalesce(budget div nullif(tokens, 0), 0) as int) AS full_epochs",
        "coalesce(budget % nullif(tokens, 0), 0) AS rem"), "mix-plan")
    keyed = (
        units.where("n_tokens > 0").join(plan.where("rem > 0"), TREE)
        .withColumn("key", F.expr(_key(seed, "full_epochs", "doc_id")))
        .select(*TREE, "key", "n_tokens", "rem", F.lit(0).cast("bigint").alias("before"))
    )
    for start in (1, 3):
        edge = stored(_narrow(keyed, start), "mix-edge")
        keyed = (
            keyed.withColumn("__p", F.expr(f"substr(key, {start}, 2)"))
            .join(edge, [*TREE, "__p"])
            .select(*TREE, "key", "n_tokens", "rem", F.col("__before").alias("before"))
        )
    last = keyed.groupBy(*TREE, "rem", "before", "key", "n_tokens").agg(F.sum("n_tokens").alias("s"))
    w = Window.partitionBy(*TREE).orderBy("key", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        last.withColumn("__upto", F.col("before") + F.sum("s").over(w))
        .where("__upto - s < rem AND rem <= __upto")
        .select(*TREE, F.col("key").alias("cut_key"), F.col("n_tokens").alias("cut_n"),
                (F.col("rem") - F.col("__upto") + F.col("s")).alias("cut_tokens"))
    )
    return stored(
        plan.join(cuts, TREE, "left").fillna({"cut_key": "", "cut_n": 0, "cut_tokens": 0}), "mix-cuts")


def _key(seed: int, epoch: str, doc_id: str) -> str:
    return f"md5(concat('{seed}|', cast({epoch} as string), '|', coalesce(cast({doc_id} as string), '')))"


def _with_cut(rows: DataFrame, tokens: str, cols: dict[str, str], plan: DataFrame, seed: int) -> DataFrame:
    """Rows with the plan's columns and ``__mix_part``, the tokens (SQL
    ``tokens``) of the last epoch's prefix that are theirs; rows with no tokens
    in the mixture are left out.  Added columns begin with ``__mix_``.
    """
    p = plan.select(*[F.col(c).alias(f"__mix_{c}") for c in [*TREE, "full_epochs", "cut_key", "cut_n", "cut_tokens"]])
    leaf = [f"__mix_{c}" for c in TREE]
    # The plan is one row per leaf; adaptive execution splits a hot leaf, or
    # broadcasts the plan if it measures small.
    keyed = (
        rows.withColumns({f"__mix_{n}": F.expr(e) for n, e in cols.items()}).join(p, leaf)
        .withColumn("__mix_key", F.expr(_key(seed, "__mix_full_epochs", "doc_id")))
    )
    at_key = "__mix_key = __mix_cut_key"
    inside = f"__mix_key < __mix_cut_key OR ({at_key} AND ({tokens}) < __mix_cut_n)"
    on_cut = f"{at_key} AND ({tokens}) = __mix_cut_n"
    clear = (
        keyed.where(f"NOT ({on_cut}) AND (__mix_full_epochs > 0 OR {inside}) AND ({tokens}) > 0")
        .withColumn("__mix_part", F.expr(f"if({inside}, ({tokens}), 0L)"))
    )
    # The rows the budget ends in, a leaf's all alike in key and tokens: each
    # task numbers its own, after those of the tasks before it.
    cut = stored(keyed.where(on_cut).withColumn("__mix_row", F.expr("monotonically_increasing_id()"))
                 .withColumn("__mix_task", F.expr("shiftright(__mix_row, 33)")), "mix-cut")
    tasks = cut.groupBy(*leaf, "__mix_task").agg(F.count(F.lit(1)).alias("__mix_n"))
    tasks = tasks.withColumn("__mix_base", F.expr(
        f"sum(__mix_n) OVER (PARTITION BY {', '.join(leaf)} ORDER BY __mix_task) - __mix_n"))
    place = f"__mix_base + row_number() OVER (PARTITION BY {', '.join([*leaf, '__mix_task'])} ORDER BY __mix_row) - 1"
    numbered = (
        cut.join(sized(stored(tasks, "mix-tasks")), [*leaf, "__mix_task"])
        .withColumn("__mix_place", F.expr(place))
        .withColumn("__mix_part", F.expr(
            "greatest(0L, least(__mix_cut_n, __mix_cut_tokens - __mix_place * __mix_cut_n))"))
        .where("__mix_full_epochs > 0 OR __mix_part > 0")
    )
    columns = [F.col(f"`{c}`") for c in rows.columns] + [
        F.col(c) for c in [*leaf, "__mix_full_epochs", "__mix_part"]]
    return clear.select(*columns).union(numbered.select(*columns))


def taken(units: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """Units with the tokens each gives to the mixture (0: left out)."""
    rows = _with_cut(units, "n_tokens", {c: c for c in TREE}, plan, seed)
    return rows.selectExpr(
        *units.columns, "__mix_full_epochs AS full_epochs", "cast(__mix_part as bigint) AS cut_part",
        "cast(__mix_full_epochs * n_tokens + __mix_part as bigint) AS tokens_taken")


def select(docs: DataFrame, plan: DataFrame, domain: str = DOMAIN, seed: int = SEED) -> DataFrame:
    """The documents with tokens in the mixture, with their own columns only."""
    tokens = TOKENS.format(text="`text`")
    rows = _with_cut(docs, tokens, _leaf_columns(docs, domain), plan, seed)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(docs: DataFrame, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS,
        weights: dict[str, str] | None = None, domain: str = DOMAIN, seed: int = SEED) -> DataFrame:
    """Per document taken: leaf, tokens and how many of them the mixture uses."""
    units = stored(leaf_tokens(docs, domain), "mix-units")
    plan = plan_of(units, percent, max_epochs, weights, seed)
    return taken(units, plan, seed).select(
        "doc_id", *TREE, "n_tokens", "full_epochs", "cut_part", "tokens_taken")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """60 % of all tokens, by weight, each document at most twice."""
    return mix(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    levels, prev = [], f"SELECT least(sum(tokens) * {PERCENT} // 100, sum(tokens) * {MAX_EPOCHS}) AS pb FROM leaves"
    for depth, level in enumerate(TREE):
        keys = ", ".join(TREE[:depth + 1])
        up = ", ".join(TREE[:depth])
        part = f"PARTITION BY {up}" if up else ""
        join = f"JOIN b{depth - 1} USING ({up})" if up else "CROSS JOIN root"
        levels.append(f"""
n{depth} AS (SELECT {keys}, sum(tokens)::HUGEINT * {MAX_EPOCHS} AS cap, ({WEIGHTS[level]})::HUGEINT AS w
  FROM leaves GROUP BY {keys}),
o{depth} AS (SELECT n.*, pb::HUGEINT AS pb,
    coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef,
    sum(w) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rw
  FROM n{depth} n {join} WINDOW r AS ({part} ORDER BY cap::DOUBLE / w::DOUBLE, {level})),
f{depth} AS (SELECT *, cap * rw <= (pb - bef) * w AS fullup FROM o{depth}),
b{depth} AS (SELECT {keys}, CASE WHEN fullup THEN cap ELSE
    (pb - sum(CASE WHEN fullup THEN cap ELSE 0 END) OVER ({part})) * w
    // sum(CASE WHEN fullup THEN 0 ELSE w END) OVER ({part}) END AS pb FROM f{depth})""")
    return rf"""
WITH u AS (SELECT doc_id, {DOMAIN.format(source="coalesce(source, '')")} AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM u GROUP BY ALL),
root AS ({prev}),{",".join(levels)},
plan AS (SELECT domain, lang, source, CASE WHEN tokens = 0 THEN 0 ELSE (pb // tokens) END::INT AS full_epochs,
    CASE WHEN tokens = 0 THEN 0 ELSE pb % tokens END AS rem FROM leaves JOIN b2 USING (domain, lang, source)),
k AS (SELECT u.*, full_epochs, rem,
    md5('{SEED}|' || full_epochs::VARCHAR || '|' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM u JOIN plan USING (domain, lang, source)),
c AS (SELECT *, greatest(0, least(n_tokens, rem - (sum(n_tokens) OVER
    (PARTITION BY domain, lang, source ORDER BY key, n_tokens
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n_tokens)))::BIGINT AS cut_part FROM k)
SELECT doc_id, domain, lang, source, n_tokens, full_epochs, cut_part,
  (full_epochs * n_tokens + cut_part)::BIGINT AS tokens_taken
FROM c WHERE full_epochs * n_tokens + cut_part > 0
"""


ORACLE = _oracle()
