"""Sniffed CSV types and dialects; quoted line breaks in split files."""

from __future__ import annotations

import random

import pytest

from casekit.sources import csvscan, files, sniff


def types_of(spark, cells):
    df = spark.createDataFrame([(c,) for c in cells], "x string").repartition(3)
    return sniff.column_types(df).first()["type"]


@pytest.mark.parametrize("cells, want", [
    (["1", "-2", "+30", None, ""], "BIGINT"), (["1", "2.5", ".5", "1e3", "inf"], "DOUBLE"),
    (["9223372036854775808"], "DOUBLE"), (["2024-01-02", " 2023-1-2 "], "DATE"),
    (["2024-01-02", "2024-01-02T03:04:05.123456"], "TIMESTAMP"), (["2024-01-02 03:04"], "TIMESTAMP"),
    (["2024-02-30"], "VARCHAR"), (["2024"], "BIGINT"), (["true", "F", "t"], "BOOLEAN"), (["1", "x"], "VARCHAR"),
    (["1d"], "VARCHAR"), ([None, "", " "], "VARCHAR"), (["1"] * 5000 + ["late"], "VARCHAR")])
def test_types(spark, cells, want):
    assert types_of(spark, cells) == want


def test_text_cells_meet_no_shape_test(spark):
    """Most cells of a table are told by their first character."""
    sql = sniff.fits_sql("c")
    assert "RLIKE" in sql
    loud = sql.replace("trim(c) RLIKE", "raise_error('tested') IS NULL AND trim(c) RLIKE")
    texts = spark.createDataFrame([("{\"a\": 1}",), ("call",), ("S12",), (" 'x",), ("é",), ("",), (None,)], "c string")
    assert [r.m for r in texts.selectExpr(f"{loud} AS m").collect()] == [0] * 5 + [sniff.ALL] * 2


@pytest.mark.parametrize("cell, types", [
    ("1", ["BIGINT", "DOUBLE"]), ("+1", ["BIGINT", "DOUBLE"]), ("99999999999999999999", ["DOUBLE"]),
    ("123e-5", ["DOUBLE"]), ("-.5", ["DOUBLE"]), ("NaN", ["DOUBLE"]), ("-inf", ["DOUBLE"]), ("in", []), ("T", ["BOOLEAN"]),
    ("true\n", ["BOOLEAN"]), ("12\n", ["BIGINT", "DOUBLE"]), ("2024-1-2", ["DATE", "TIMESTAMP"]),
    ("2024-01-02\r\n", ["DATE", "TIMESTAMP"]), ("2024-1-2 1:00", ["TIMESTAMP"]), ("2024-13-01", []), ("+", []), ("1.2.3", [])])
def test_types_of_one_cell(spark, cell, types):
    mask = spark.createDataFrame([(cell,)], "c string").selectExpr(f"{sniff.fits_sql('c')} AS m").first().m
    assert [t for i, t in enumerate(sniff.TYPES) if mask >> i & 1] == types


def test_dialects_and_typed_reading(spark, tmp_path):
    cases = {
        "comma": ("id,when,name\n1,2024-01-02,\"a,b\"\n2,2024-01-03,c\n", ",", True),
        "semi": ("id;score\n1;2,5\n2;3,5\n", ";", True),
        "tab": ("a\tb\n1\tx\n", "\t", True), "pipe": ("1|2.5|z\n3|4.5|y\n", "|", False),
        "text": ("first,second\nx,y\nz,w\n", ",", True), "one": ("n\n1\n2\n", ",", True)}
    for name, (text, delimiter, header) in cases.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        d = sniff.sniff_dialect(spark, str(path))
        assert (d.delimiter, d.header) == (delimiter, header), name
    df = sniff.read_csv_auto(spark, str(tmp_path / "comma.csv"))
    assert dict(df.dtypes) == {"id": "bigint", "when": "date", "name": "string"}
    assert df.selectExpr("sum(id)", "max(name)").first() == (3, "c")
    df = sniff.read_csv_auto(spark, str(tmp_path / "pipe.csv"))
    assert df.columns == ["column0", "column1", "column2"] and df.selectExpr("sum(column1)").first()[0] == 7.0


@pytest.fixture()
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "3000")
    spark.conf.set(keys[1], "0")
    yield
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def write_lined(folder, end, seed, rows=500):
    """A CSV whose cells hold line breaks, quotes and delimiters; its rows."""
    rng, out = random.Random(seed), []
    with open(f"{folder}/{seed}.csv", "w", newline="", encoding="utf-8") as f:
        f.write("id,text,n" + end)
        for i in range(rows):
            text = "".join(rng.choice(["a", "b ", ",", '"', "\n", "é"]) for _ in range(rng.randrange(0, 30)))
            if i == rows // 2:
                text = "long\n" * 4000  # many whole splits inside one cell
            if i % 50 == 3:
                f.write(end)  # a blank line between records
            cell = '"' + text.replace('"', '""') + '"'
            f.write(f"{seed * 10000 + i},{cell},{i % 7}{end}")
            out.append((str(seed * 10000 + i), text or None, str(i % 7)))
    return out


def test_quoted_line_breaks_over_many_splits(spark, tmp_path, small_splits):
    want = write_lined(tmp_path, "\n", 1) + write_lined(tmp_path, "\r\n", 2)
    got = csvscan.read_quoted_csv(spark, str(tmp_path), "bad")
    rows = got.collect()
    assert all(r.bad is None for r in rows)
    assert sorted((r.id, r.text, r.n) for r in rows) == sorted(want)
    one = spark.read.options(header="true", multiLine="true", quote='"', escape='"').csv(str(tmp_path))
    assert sorted(map(tuple, one.collect())) == sorted(want)
    split = csvscan._lines(spark, str(tmp_path)).rdd.getNumPartitions()
    assert one.rdd.getNumPartitions() <= 2 and split > 10


def test_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,n\n1,"x\ny",2\n')
    (tmp_path / "b.csv").write_text('id,n,text\n1,2,"x\ny"\n')
    with pytest.raises(Exception, match="another header"):
        csvscan.read_quoted_csv(spark, str(tmp_path), "bad").collect()


def test_feedback_extract_with_line_breaks(spark, tmp_path, small_splits):
    (tmp_path / "f.csv").write_text(
        "id,case_id,csat_score,nps_bucket,feedback_text,submitted_at\n"
        + "".join(f'{i},{i % 9},{i % 5}.5,passive,"line {i}\nnext ""{i}""\n",2024-01-02\n' for i in range(900)))
    got = files.read_raw_csv(spark, str(tmp_path / "f.csv"), "patient_feedback", multi_line=True)
    rows = sorted(map(tuple, got.collect()))
    assert len(rows) == 900 and rows[7] == (7, 7, 2.5, "passive", 'line 7\nnext "7"\n', "2024-01-02")
    reject = files.csv_rejects(spark, str(tmp_path / "f.csv"), "patient_feedback", multi_line=True).first()
    assert (reject.row_count, reject.broken_rows, reject.bad_cells) == (900, 0, 0)


def test_an_empty_mart_is_ready(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    assert files.mart_ready(spark, str(tmp_path / "empty")) and not files.mart_ready(spark, str(tmp_path / "none"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.parquet").write_text("no parquet")
    assert not files.mart_ready(spark, str(tmp_path / "bad"))
