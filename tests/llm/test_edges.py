"""Every operator over the awkward tables and over empty ones."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from casekit.llm.queries import oracle_sql, queries
from tests.llm import tables
from tools.oracle_check import compare, duck_for

NAMES = sorted(queries())
INPUT = {"op3_exact_topk": "embeddings", "op9_warc": "pages"}


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty, name):
    assert entry.queries()[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", sorted(set(NAMES) & set(oracle_sql())))
def test_awkward_tables_match_sql(spark, awkward, name):
    got = entry.queries()[name](spark, awkward).toPandas()
    want = duck_for(awkward).execute(oracle_sql()[name]).df()
    if name in ("op1_decontaminate", "op2_near_duplicates"):  # SQL groups by id: compare known, single ids
        single = [i for i in range(len(tables.documents())) if i != 20]
        got, want = (x[x.doc_id.isin(single)].assign(doc_id=lambda d: d.doc_id.astype(int)) for x in (got, want))
    ok, message = compare(got, want)
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(NAMES) - set(oracle_sql()) - {"op4_token_shards"}))
def test_awkward_tables_give_one_row_per_document(spark, awkward, name):
    got = entry.queries()[name](spark, awkward).toPandas()
    docs = tables.documents()
    assert len(got) == len(docs)
    assert sorted(got.doc_id.dropna().astype(int)) == sorted(d["doc_id"] for d in docs if d["doc_id"] is not None)


def test_repeated_and_null_ids_in_near_duplicates(spark, awkward):
    got = entry.queries()["op2_near_duplicates"](spark, awkward).toPandas()
    twice = got[got.doc_id == 20]
    assert len(twice) == 2 and twice.component_id.nunique() == 1
    nothing = got[got.doc_id.isna()].iloc[0]
    assert nothing.kept and nothing.component_id != nothing.component_id  # null


def test_repeated_and_null_ids_in_decontamination(spark, awkward):
    got = entry.queries()["op1_decontaminate"](spark, awkward).toPandas()
    assert len(got[got.doc_id == 20].drop_duplicates()) == 1
    copy, null_id = got[got.doc_id == 7].iloc[0], got[got.doc_id.isna()].iloc[0]
    assert (copy.n_hit, copy.items_sha256) == (null_id.n_hit, null_id.items_sha256)
