"""The golden micro fixture of FIXTURES.md §3 as raw DataFrames and CSV text."""

from __future__ import annotations

import datetime as dt
import json

from casekit import schemas

AS_OF = "2024-03-01 12:30:00"


def _ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def _meta(**kw):
    return json.dumps(kw)


CASES = [
    # id, advocate, case_type, urgency, status, created, first_response, resolved, esc, reopen, metadata
    (1, 1, "prior_authorization", " high ", "resolved", "2024-01-01T10:59:00", "2024-01-01T14:00:00",
     "2024-01-09T00:01:00", 1, 0, _meta(handoff_count=3, missing_docs=True, barriers=["language", "none"])),
    (2, 1, "prior_authorization", "low", "reopened", "2024-01-10T08:00:00", "2024-01-10T20:30:00",
     "2024-01-17T23:00:00", 0, 1, _meta(handoff_count=1, missing_docs=False)),
    (3, 2, "claim_denial", "medium", "open", "2024-02-22T09:00:00", "", "", 0, 0,
     _meta(handoff_count=None, complexity=None, missing_docs=True)),
    (4, 2, "claim_denial", "high", "in_progress", "2024-02-28T11:59:00", "", "", 0, 0,
     _meta(handoff_count=2)),
    (5, 3, "billing_dispute", "low", "pending_docs", "2024-02-28T08:00:00", "", "", 1, 0, None),
]

EVENTS = [
    (1, 1, "first_response", "2024-01-01T15:00:00"),
    (2, 1, "first_response", "2024-01-01T13:59:00"),
    (3, 4, "first_response", "2024-02-28T13:59:00"),
    (4, 4, "opened", "2024-02-28T11:59:00"),
]

INTERACTIONS = [
    (1, 2, "call", "2024-01-11T09:00:00", 10.0, 1),
    (2, 2, "email", "2024-01-12T09:00:00", 20.0, 1),
    (3, 4, "call", "2024-02-28T11:59:00", 5.0, 2),
    (4, 5, "doc_request", "2024-02-28T12:00:00", 0.0, 3),
]

FEEDBACK = [
    (1, 1, 3.4, "detractor", "thanks, great", "2024-01-10T00:00:00"),
    (2, 2, 2.0, "detractor", "", "2024-01-19T00:00:00"),
]

ADVOCATES = [
    (1, " Ann Lee ", "prior_auth", "intake", 2, "2022-01-01"),
    (2, "Bo Chan", "claims", "resolution", 1, "2022-02-01"),
    (3, "Cy Diaz", "billing", "intake", 0, "2022-03-01"),
    (4, "Di Eng", "general", "specialty", 10, "2022-04-01"),
]

PATIENTS = [(10 * i, "commercial", "phone", "CA", 0.4, _ts("2023-01-01T00:00:00")) for i in range(1, 6)]


def raw_frames(spark):
    cases = [
        (cid, 10 * cid, adv, ct, urg, st, _ts(cr), _ts(cr) + dt.timedelta(hours=1), fr, rs, e, r, m)
        for (cid, adv, ct, urg, st, cr, fr, rs, e, r, m) in CASES
    ]
    return {
        "patients": spark.createDataFrame(PATIENTS, schemas.PATIENTS),
        "advocates": spark.createDataFrame(
            [(a, n, s, t, c, dt.date.fromisoformat(h)) for a, n, s, t, c, h in ADVOCATES],
            schemas.ADVOCATES,
        ),
        "cases": spark.createDataFrame(cases, schemas.CASES),
        "interactions": spark.createDataFrame(
            [(i, c, t, _ts(ts), d, a) for i, c, t, ts, d, a in INTERACTIONS], schemas.INTERACTIONS
        ),
        "case_events": spark.createDataFrame(
            [(i, c, t, _ts(ts)) for i, c, t, ts in EVENTS], schemas.CASE_EVENTS
        ),
        "patient_feedback": spark.createDataFrame(
            [(i, c, s, n, t, _ts(ts)) for i, c, s, n, t, ts in FEEDBACK], schemas.PATIENT_FEEDBACK
        ),
    }


def _csv_cell(v):
    if v is None:
        return ""
    s = str(v)
    if any(ch in s for ch in ',"\r\n') or s != s.strip():
        return '"' + s.replace('"', '""') + '"'
    return s


def write_csv_files(folder, line_end="\r\n"):
    """The fixture as CSV text like the reference's extracts (CRLF, quoted JSON, blanks)."""
    from casekit.sources.files import RAW_FILES

    rows = {
        "patients": (["id", "insurance_type", "preferred_channel", "state", "risk_score", "created_at"],
                     [(p[0], p[1], p[2], p[3], p[4], "2023-01-01T00:00:00") for p in PATIENTS]),
        "advocates": (["id", "name", "specialty", "team", "capacity", "hire_date"], ADVOCATES),
        "cases": (["id", "patient_id", "advocate_id", "case_type", "urgency", "status", "created_at",
                   "assigned_at", "first_response_at", "resolved_at", "escalation_flag", "reopen_flag",
                   "metadata_json"],
                  [(c[0], 10 * c[0], c[1], c[2], c[3], c[4], c[5],
                    (_ts(c[5]) + dt.timedelta(hours=1)).isoformat(), c[6], c[7], c[8], c[9], c[10])
                   for c in CASES]),
        "interactions": (["id", "case_id", "type", "created_at", "duration_minutes", "advocate_id"],
                         INTERACTIONS),
        "case_events": (["id", "case_id", "event_type", "occurred_at"], EVENTS),
        "patient_feedback": (["id", "case_id", "csat_score", "nps_bucket", "feedback_text", "submitted_at"],
                             FEEDBACK),
    }
    for table, (header, data) in rows.items():
        path = f"{folder}/{RAW_FILES[table]}"
        with open(path, "w", newline="") as fh:
            fh.write(",".join(header) + line_end)
            for r in data:
                fh.write(",".join(_csv_cell(v) for v in r) + line_end)
