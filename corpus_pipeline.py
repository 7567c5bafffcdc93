"""The corpus pipeline: five operators over ``documents``, in order.

Each stage gets the documents its predecessor kept, as a Parquet table it
reads again, and returns documents with their own columns; the last returns
the token shards' slots.  A lost executor costs the running stage's lost
tasks only.

* ``language_id`` drops documents whose language is not recognised.
* ``near_dedup`` keeps the smallest doc_id of each group of near copies
  (five-word shingles, similarity of 0.8 or more).
* ``decontaminate`` drops documents of which a twentieth or more lies in
  13-word windows of ``benchmark`` items.
* ``mixing`` keeps the documents with tokens in the mixture: 80 % of the
  tokens left, by target weights, each document at most once.
* ``token_shards`` writes all sequences in training order.

Null, empty and very long texts, repeated rows and extra columns behave as
each operator states; null and empty texts go in the first stage (no
language).  An empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casekit.llm import decontaminate, langid, mixing, neardup, tokens
from casekit.llm.common import prepare, stored, table

MIX_PERCENT = 80


def _language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return langid.keep_identified(docs)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return neardup.keep_one(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plan = mixing.mixture_plan(docs, percent=MIX_PERCENT, max_epochs=1)
    return mixing.select(docs, plan)


def _token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.materialise(docs)


STAGES = [
    ("language_id", _language_id),
    ("near_dedup", _near_dedup),
    ("decontaminate", _decontaminate),
    ("mixing", _mixing),
    ("token_shards", _token_shards),
]

# A trained model, min-hashing and a tokenizer are not SQL; the tests compare
# the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
