"""Connected components of a link table, as Spark jobs.

Alternating large-star / small-star steps: every step replaces each node's
links by links to the smallest id around it, until the links are stars around
the component's smallest id.  Minimums are combined map-side, so a node with
very many links costs one row per task; the tables joined back are stored
first and broadcast only when counted small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.llm.common import sized, stored


def _fingerprint(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (x, y bigint).

    ``component`` is the smallest id reachable.  Nodes without links are not
    listed; self links and nulls are ignored.
    """
    e = stored(
        links.where("x IS NOT NULL AND y IS NOT NULL AND x <> y")
        .selectExpr("greatest(x, y) AS u", "least(x, y) AS v").distinct(), "links")
    before = None
    while before != (now := _fingerprint(e)):
        before = now
        if not now[0]:
            break
        both = e.union(e.selectExpr("v AS u", "u AS v"))
        low = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "star")
        # Large star: larger neighbours point to the smallest around the node.
        e = both.join(sized(low), "u").where("v > u").selectExpr("v AS u", "m AS v").distinct()
        e = stored(e.where("u <> v"), "links")
        low = stored(e.groupBy("u").agg(F.min("v").alias("m")), "star")
        # Small star: the node and its smaller neighbours point to their smallest.
        e = e.join(sized(low), "u").selectExpr("explode(array(u, v)) AS u", "m AS v")
        e = stored(e.where("u <> v").distinct(), "links")
    return e.selectExpr("u AS node", "v AS component").union(
        e.selectExpr("v AS node", "v AS component").distinct())
