"""Shuffle-free event numbering equals a plain per-case enumeration."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from casekit import schemas
from casekit.operators.eventlog import EVENT_ORDER, event_log
from casekit.operators.staging import stg_cases

BASE = dt.datetime(2024, 1, 1, 9, 0)

case_rows = st.lists(
    st.tuples(
        st.booleans(),                       # created present
        st.booleans(),                       # assigned present
        st.booleans(),                       # first response present
        st.booleans(),                       # resolved present
        st.sampled_from([None, True, False]),  # missing_docs
    ),
    min_size=1, max_size=12,
)


def _expected(row):
    created, assigned, fr, resolved, missing = row
    t_created = BASE if created else None
    t_assigned = BASE + dt.timedelta(hours=1) if assigned else None
    t_fr = BASE + dt.timedelta(hours=3) if fr else (
        t_assigned + dt.timedelta(hours=12) if t_assigned else None)
    t_res = BASE + dt.timedelta(days=5) if resolved else None
    times = [
        t_created, t_assigned, t_fr,
        t_fr + dt.timedelta(hours=2) if (missing and t_fr) else None,
        t_res - dt.timedelta(days=1) if (missing and t_res) else None,
        t_res,
    ]
    present = [(name, t) for name, t in zip(EVENT_ORDER, times) if t is not None]
    return [(i + 1, name, t) for i, (name, t) in enumerate(present)]


@settings(max_examples=15, deadline=None)
@given(case_rows)
def test_event_numbering_matches_enumeration(spark, rows):
    raw = []
    for cid, (created, assigned, fr, resolved, missing) in enumerate(rows, start=1):
        meta = None if missing is None else ('{"missing_docs": %s}' % str(missing).lower())
        raw.append((cid, cid, 1, "x", "low", "open",
                    BASE if created else None,
                    BASE + dt.timedelta(hours=1) if assigned else None,
                    (BASE + dt.timedelta(hours=3)).isoformat() if fr else None,
                    (BASE + dt.timedelta(days=5)).isoformat() if resolved else None,
                    0, 0, meta))
    got = {}
    for r in event_log(stg_cases(spark.createDataFrame(raw, schemas.CASES))).collect():
        got.setdefault(r.case_id, []).append((r.seq, r.event_type, r.occurred_at))
    for cid, row in enumerate(rows, start=1):
        exp = _expected(row)
        assert sorted(got.get(cid, [])) == exp
