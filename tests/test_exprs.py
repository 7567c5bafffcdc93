"""T1–T3, T2 rounding and text formatting, checked against DuckDB on random values."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from casekit.functions.exprs import days_between, fmt_number, hour_boundaries, hours_between, round2, text_to_int


def _random_pairs(n=3000, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2020, 1, 1)
    rows = []
    for _ in range(n):
        a = base + dt.timedelta(microseconds=rnd.randrange(0, 4 * 365 * 86400 * 10**6))
        span = rnd.choice([rnd.randrange(-10**6, 10**6), rnd.randrange(-86400 * 10**6 * 30, 86400 * 10**6 * 30),
                           3600 * 10**6 * rnd.randrange(-100, 100), 60 * 10**6 * rnd.randrange(-5000, 5000)])
        rows.append((a, a + dt.timedelta(microseconds=span)))
    rows += [(dt.datetime(2024, 1, 1, 10, 59), dt.datetime(2024, 1, 1, 11, 1)),
             (dt.datetime(2024, 2, 28, 11, 59), dt.datetime(2024, 3, 1, 12, 30)),
             (dt.datetime(2024, 2, 28, 12, 0), dt.datetime(2024, 3, 1, 12, 30))]
    return rows


def test_time_differences_match_duckdb(spark):
    rows = _random_pairs()
    pdf = pd.DataFrame(rows, columns=["a", "b"])
    sdf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i long, a timestamp_ntz, b timestamp_ntz")
    got = sdf.select("i", hours_between("a", "b").alias("h"), hour_boundaries("a", "b").alias("hb"),
                     days_between("a", "b").alias("d")).orderBy("i").toPandas()
    pdf["i"] = range(len(rows))
    exp = duckdb.sql(
        "SELECT i, EXTRACT(EPOCH FROM (b - a)) / 3600.0 AS h, DATE_DIFF('hour', a, b) AS hb, "
        "DATE_DIFF('day', CAST(a AS DATE), CAST(b AS DATE)) AS d FROM pdf ORDER BY i"
    ).df()
    assert list(got["hb"]) == list(exp["hb"])
    assert list(got["d"]) == list(exp["d"])
    assert list(got["h"]) == list(exp["h"])  # bit-exact
    hb = dict(zip(got["i"], got["hb"]))
    assert hb[len(rows) - 3] == 1 and hb[len(rows) - 2] == 49 and hb[len(rows) - 1] == 48


def test_round2_matches_duckdb(spark):
    rnd = random.Random(3)
    vals = [rnd.uniform(-1000, 1000) for _ in range(3000)]
    vals += [k / 1000 for k in range(0, 5000, 5)]  # many decimal ties
    vals += [1.005, 2.675, 0.125, -0.125, 7.75, 2.7]
    pdf = pd.DataFrame({"i": range(len(vals)), "x": vals})
    got = spark.createDataFrame(pdf).select("i", round2("x").alias("r")).orderBy("i").toPandas()
    exp = duckdb.sql("SELECT i, ROUND(x, 2) AS r FROM pdf ORDER BY i").df()
    assert list(got["r"]) == list(exp["r"])
    assert dict(zip(got["i"], got["r"]))[len(vals) - 6] == 1.0  # 1.005 -> 1.00


def test_fmt_number_matches_printf(spark):
    vals = [k / 40 for k in range(-400, 400)] + [0.15, 0.25, 2.675, 7.25, None]
    pdf = pd.DataFrame({"i": range(len(vals)), "x": vals})
    got = spark.createDataFrame(list(enumerate(vals)), "i long, x double").select(
        "i", fmt_number("x", 1).alias("t1"), fmt_number("x", 2).alias("t2")).orderBy("i").toPandas()
    exp = duckdb.sql("SELECT i, COALESCE(printf('%.1f', x), '—') AS t1, "
                     "COALESCE(printf('%.2f', x), '—') AS t2 FROM pdf ORDER BY i").df()
    py = [("—" if v is None else f"{v:.1f}") for v in vals]
    assert list(got["t1"]) == py
    assert list(got["t1"]) == list(exp["t1"]) and list(got["t2"]) == list(exp["t2"])


def test_text_to_int_is_lenient(spark):
    df = spark.createDataFrame([("3",), ("3.0",), ("3.7",), (" 4 ",), ("x",), (None,)], "t string")
    got = [r.v for r in df.select(text_to_int("t").alias("v")).collect()]
    assert got == [3, 3, 4, 4, None, None]


def test_text_to_int_matches_duckdb_cast(spark):
    """Numeric text -> INTEGER like the reference's CAST, ties away from zero."""
    vals = ["0.5", "1.5", "2.5", "-0.5", "-1.5", "-2.5", "3.7", "-3.7", "3", " 4 ", "1e2",
            "2.4999999999", "007", "+5", "3.0"]
    got = [r.v for r in spark.createDataFrame([(v,) for v in vals], "t string")
           .select(text_to_int("t").alias("v")).collect()]
    exp = [duckdb.execute("SELECT CAST(? AS INTEGER)", [v]).fetchall()[0][0] for v in vals]
    assert got == exp
