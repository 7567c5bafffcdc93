"""Pre-aggregated caseload (J4 re-aimed) equals the direct advocates ⟕ fact form."""

from __future__ import annotations

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from casekit.operators.marts import advocate_caseload

STATUSES = [None, "open", "in_progress", "pending_docs", "escalated", "resolved", "reopened"]

advocates_st = st.lists(
    st.tuples(st.sampled_from([1, 2, 3, None]), st.sampled_from(["a", "b"]),
              st.sampled_from([0, 1, 2, None])),
    min_size=1, max_size=6,
)
fact_st = st.lists(
    st.tuples(st.sampled_from([1, 2, 3, 4, None]), st.sampled_from(STATUSES),
              st.one_of(st.none(), st.integers(1, 50))),
    min_size=0, max_size=25,
)


def expected(advocates, fact):
    """One row per distinct advocate; repeated advocates count their cases once each."""
    for a in set(advocates):
        active = advocates.count(a) * sum(
            case is not None and owner is not None and owner == a[0] and status not in (None, "resolved", "reopened")
            for case, owner, status in fact)
        yield (*a, active, math.floor(active / a[4] * 100 + 0.5) / 100 if a[4] else None)


def _norm(rows):
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in rows), key=repr)


@settings(max_examples=12, deadline=None)
@given(advocates_st, fact_st)
def test_preaggregated_caseload_equals_direct_join(spark, advs, fact_rows):
    adv_rows = [(i, n, "t", "s", c) for i, n, c in advs]
    f_rows = [(cid, a, s) for a, s, cid in fact_rows]
    adv = spark.createDataFrame(adv_rows, "id long, name string, team string, specialty string, capacity int")
    fact = spark.createDataFrame(f_rows, "case_id long, advocate_id long, status string")
    got = _norm(tuple(r) for r in advocate_caseload(adv, fact).select(
        "advocate_id", "name", "team", "specialty", "capacity", "active_cases", "utilization_ratio").collect())
    assert got == _norm([(i, n, t, c, x, k, u) for i, n, t, c, x, k, u in expected(adv_rows, f_rows)])
