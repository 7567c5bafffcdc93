"""CSV in and out without loss: headers, bad rows and cells, line breaks, padding."""

from __future__ import annotations

import pytest

from casekit import schemas
from casekit.sources import files

EVENTS = "id,case_id,event_type,occurred_at\n"
FEEDBACK = "id,case_id,csat_score,nps_bucket,feedback_text,submitted_at\n"


def _write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_columns_are_taken_by_header_name(spark, tmp_path):
    path = _write(tmp_path, "e.csv", "case_id,extra,occurred_at,id,event_type\n7,x,2024-01-01T00:00:00,1,opened\n")
    df = files.read_raw_csv(spark, path, "case_events")
    assert df.columns == schemas.CASE_EVENTS.fieldNames()
    assert [tuple(r) for r in df.collect()] == [(1, 7, "opened", "2024-01-01T00:00:00")]


def test_a_missing_column_is_an_error(spark, tmp_path):
    path = _write(tmp_path, "e.csv", "id,event_type,occurred_at\n1,opened,2024-01-01T00:00:00\n")
    with pytest.raises(ValueError, match="no column case_id"):
        files.read_raw_csv(spark, path, "case_events")


@pytest.mark.parametrize("bad, message", [("x1,7,opened,t\n", "bad id: x1"), ("1,7\n", "broken row"),
                                          ("1,7,opened,t,more\n", "broken row")])
def test_bad_rows_fail_the_load_and_are_counted(spark, tmp_path, bad, message):
    path = _write(tmp_path, "e.csv", EVENTS + "1,7,opened,2024-01-01T00:00:00\n" + bad)
    with pytest.raises(Exception, match=message):
        files.read_raw_csv(spark, path, "case_events").collect()
    row = files.csv_rejects(spark, path, "case_events").first()
    broken = message == "broken row"
    assert (row.row_count, row.broken_rows, row.bad_cells) == (2, int(broken), int(not broken))
    kept = files.read_raw_csv(spark, path, "case_events", strict=False).collect()
    assert [r.id for r in kept] == ([1] if broken else [1, None])


def test_line_breaks_inside_cells(spark, tmp_path):
    path = _write(tmp_path, "f.csv", FEEDBACK + '1,2,3.5,passive,"two\nlines, ""quoted""",2024-01-01T00:00:00\n'
                  "2,3,,promoter,,2024-01-02T00:00:00\n")
    rows = files.read_raw_csv(spark, path, "patient_feedback", multi_line=True).collect()
    assert [r.feedback_text for r in rows] == ['two\nlines, "quoted"', None]
    assert rows[1].csat_score is None


def test_padding_survives_the_round_trip(spark, tmp_path):
    texts = [" ok ", "a, b", 'say "x"', "  ", "\ttab"]
    df = spark.createDataFrame([(i, 1, 2.0, "passive", t, None) for i, t in enumerate(texts)],
                               schemas.PATIENT_FEEDBACK)
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_raw_csv(spark, str(tmp_path / "out"), "patient_feedback").orderBy("id").collect()
    assert [r.feedback_text for r in back] == texts


def test_parquet_columns_get_the_declared_types(spark, tmp_path):
    for table, schema in schemas.RAW.items():
        names = ", ".join(f"CAST(NULL AS STRING) AS {f.name}" for f in schema.fields)
        spark.sql(f"SELECT {names}").write.parquet(str(tmp_path / f"{table}.parquet"))
    raw = files.read_raw_tables(spark, str(tmp_path), "parquet")
    for table, schema in schemas.RAW.items():
        assert raw[table].schema.simpleString() == schema.simpleString()
