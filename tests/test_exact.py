"""Order-independent sums and means."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from casekit.functions.exact import exact_avg_sql, exact_sum_sql, int_avg_sql
from casekit.operators import marts, reports
from casekit.operators.timings import interaction_stats
from casekit.plans import catalogue


def bits(rows):
    return sorted(str([x.hex() if isinstance(x, float) else x for x in r]) for r in rows)


def shuffled(df, spark, parts, seed):
    rows = df.collect()
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, df.schema).repartition(parts) if parts > 1 else spark.createDataFrame(
        rows, df.schema).coalesce(1)


def values(rng, n):
    out = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(-12, 14) for _ in range(n)]
    out += [-x for x in out[: n // 2]] + [0.1, 0.2, 0.3, -0.0, 1 / 3, 2.0 ** 47, -(2.0 ** 47) + 0.5]
    return out


def test_sums_are_the_true_sum_rounded(spark):
    rng = random.Random(1)
    for n in (1, 2, 50, 3000):
        xs = values(rng, n)
        df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(7)
        total, mean = df.selectExpr(f"{exact_sum_sql('x')} AS s", f"{exact_avg_sql('x')} AS m").first()
        true = sum(map(Fraction, xs))
        assert abs(Fraction(total) - true) <= Fraction(math.ulp(float(true)))
        assert total == math.fsum(xs) or abs(total - math.fsum(xs)) <= math.ulp(total)
        assert mean == total / len(xs)


def test_cancellation_loses_nothing(spark):
    df = spark.createDataFrame([(x,) for x in (1e14, 1e-9, -1e14, 2e-9)], "x double")
    assert df.selectExpr(f"{exact_sum_sql('x')} AS s").first()[0] == pytest.approx(3e-9, rel=1e-15)


def test_nothing_nulls_and_values_off_the_grid(spark):
    df = spark.createDataFrame([(1, None), (2, 1.5), (2, None), (3, float("inf")), (3, 1.0), (4, float("nan")),
                                (5, 1e300), (5, 1.0), (6, 1e-200)], "k int, x double")
    got = {r.k: (r.s, r.m) for r in df.groupBy("k").agg(
        *[F.expr(e)
          for e in (f"{exact_sum_sql('x')} AS s", f"{exact_avg_sql('x')} AS m")]).collect()}
    assert got[1] == (None, None) and got[2] == (1.5, 1.5) and got[3][0] == math.inf and math.isnan(got[4][1])
    assert got[5] == (1e300, 5e299) and got[6] == (0.0, 0.0)


def test_integer_means(spark):
    df = spark.createDataFrame([(2 ** 60,), (2 ** 60 + 2,), (None,)], "x bigint")
    assert df.selectExpr(f"{int_avg_sql('x')} AS m").first()[0] == (2 ** 61 + 2) / 2


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_marts_and_reports_are_bit_equal_over_partitions(spark, parts):
    m = catalogue.models(spark, "/root/testdata/sf0.001")
    fact = m["fct_case_lifecycle"].cache()
    inter = m["stg_interactions"].cache()
    other = shuffled(fact, spark, parts, parts)
    for fn in (marts.ops_kpis, marts.bottlenecks, reports.exec_headline, reports.handoffs_vs_csat,
               reports.interaction_load, reports.case_type_delay, reports.escalation_vs_sla):
        assert bits(fn(fact).collect()) == bits(fn(other).collect()), fn.__name__
    assert bits(interaction_stats(inter).collect()) == bits(
        interaction_stats(shuffled(inter, spark, parts, parts)).collect())
    rng = random.Random(3)
    rows = spark.createDataFrame([(rng.random() * 1e6 - 5e5,) for _ in range(20_000)], "x double")
    means = {shuffled(rows, spark, parts, seed).selectExpr(exact_avg_sql("x")).first()[0] for seed in range(3)}
    assert len(means) == 1
