"""Single-pass bottlenecks equal the three-branch UNION ALL (NULL flags included)."""

from __future__ import annotations

import collections
import datetime as dt
import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from casekit.operators.marts import bottlenecks

T0 = dt.datetime(2024, 1, 1)

rows_st = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),                 # case_type
        st.sampled_from([True, False, None]),               # missing_docs
        st.sampled_from([0, 1, 2, 3, 7]),                   # handoff_count
        st.booleans(),                                      # resolved
        st.one_of(st.none(), st.sampled_from([1.0, 2.5, 4.0])),  # csat
        st.sampled_from([True, False, None]),               # sla_breach_flag
        st.integers(0, 20),                                 # days
    ),
    min_size=1, max_size=30,
)


def mean(values):
    known = [v for v in values if v is not None]
    return round2(sum(known) / len(known)) if known else None


def round2(x):
    """Scale, round half away from zero, unscale."""
    return math.copysign(math.floor(abs(x) * 100 + 0.5) / 100, x) if x else x


def expected(rows):
    """(analysis, segment) rows from the drawn tuples; a NULL flag is a group of its own."""
    groups = collections.defaultdict(list)
    for row in rows:
        case_type, missing, handoffs, resolved, csat, _, _ = row
        if resolved:
            groups["missing_docs_vs_resolution", str(missing), "missing_docs" if missing else "docs_complete"].append(row)
        if csat is not None:
            name = ("0-1_handoffs", "0-1_handoffs", "2_handoffs", "3+_handoffs")[min(handoffs, 3)]
            groups["handoffs_vs_csat", name, name].append(row)
        groups["case_type_vs_sla_breach", case_type, case_type].append(row)
    for (analysis, _, name), members in groups.items():
        late = round2(100 * sum(bool(r[5]) for r in members) / len(members))
        by_type = analysis == "case_type_vs_sla_breach"
        yield (analysis, name, len(members), mean([r[6] if r[3] else None for r in members]),
               None if by_type else mean([r[4] for r in members]), late if by_type else None)


def _norm(rows):
    return sorted((tuple(None if (v is None or (isinstance(v, float) and pd.isna(v))) else v
                         for v in r) for r in rows), key=repr)


@settings(max_examples=15, deadline=None)
@given(rows_st)
def test_single_pass_equals_union_all(spark, rows):
    data = [(ct, md, h, T0 if res else None, c, sla, d if res else None)
            for ct, md, h, res, c, sla, d in rows]
    schema = ("case_type string, missing_docs boolean, handoff_count int, resolved_at timestamp_ntz, "
              "csat_score double, sla_breach_flag boolean, days_to_resolution long")
    got = _norm(tuple(r) for r in bottlenecks(spark.createDataFrame(data, schema)).collect())
    assert got == _norm(expected(rows))
