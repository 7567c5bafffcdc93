"""M8 -> M9-M11: marts kept up to date from the fact's changes.

A full refresh aggregates every fact row again.  A maintained mart stores, per
group, sums that can be taken back: counts, integer sums and the limbs of exact
double sums (``functions.exact``).  A change of the fact is the rows that left
it, with sign -1, and the rows that came, with sign +1; the change is
aggregated with the same sums and added to the stored ones.  As everything is
integer arithmetic, the mart is bit for bit what a full rebuild gives.

The fact may hold several rows a case (feedback fans out), so changes are found
by case: every case whose rows differ is taken out whole and put in whole.
Values of 2^48 or more, infinities and NaN are kept as plain doubles, which
cannot be taken back exactly; a state that holds any is rebuilt
(``needs_rebuild``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.functions.exact import mean_sql, partial_sqls
from casekit.functions.exprs import pct_sql, ratio_sql, round2_sql
from casekit.operators import marts

SIGN = "__sign"


def _count(pred: str) -> str:
    return f"if({pred}, 1L, 0L)"


def _double(x: str) -> dict[str, str]:
    return {f"{x}_{n}": part for n, part in partial_sqls(x).items()}


def _whole(x: str) -> dict[str, str]:
    return {f"{x}_sum": f"coalesce(CAST({x} AS BIGINT), 0L)", f"{x}_n": _count(f"{x} IS NOT NULL")}


def _mean(x: str) -> str:
    return mean_sql({n: f"{x}_{n}" for n in partial_sqls(x)})


def _whole_mean(x: str) -> str:
    return ratio_sql(f"{x}_sum", f"{x}_n")


@dataclass(frozen=True)
class Mart:
    """Group keys, row-level summands (after ``rows`` prepared the fact) and the
    mart's columns from their sums.  ``n`` counts a group's rows."""

    keys: tuple[str, ...]
    parts: dict[str, str]
    columns: tuple[str, ...]
    rows: str = "fact"

    def state(self, rows: DataFrame) -> DataFrame:
        """Sums per group of fact rows; a ``__sign`` column weights them."""
        if self.rows == "bottlenecks":
            rows = marts._bottleneck_rows(rows, *([SIGN] if SIGN in rows.columns else []))
        sign = f"{SIGN} * " if SIGN in rows.columns else ""
        return rows.groupBy(*self.keys).agg(*[
            F.expr(f"sum({sign}({part})) AS `{name}`") for name, part in self.parts.items()])

    def merge(self, *states: DataFrame) -> DataFrame:
        """States added up; groups without rows are gone."""
        both = reduce(DataFrame.unionByName, states)
        return both.groupBy(*self.keys).agg(*[
            F.expr(f"sum(`{name}`) AS `{name}`") for name in self.parts]).where("n <> 0")

    def finish(self, state: DataFrame) -> DataFrame:
        return state.selectExpr(*self.columns)

    def needs_rebuild(self, state: DataFrame) -> bool:
        """Whether a sum holds plain doubles (a row at most reaches the driver)."""
        large = [n for n in self.parts if n.endswith("_large")]
        if not large:
            return False
        return len(state.where(" OR ".join(f"NOT (`{n}` <=> 0D)" for n in large)).limit(1).collect()) > 0


OPS_KPIS = Mart(
    ("case_type",),
    {"n": "1L", "active": _count(marts.IS_ACTIVE), "closed": _count(marts.IS_CLOSED),
     "escalated": _count("escalation_flag"), "reopened": _count("reopen_flag"),
     "late": _count("sla_breach_flag"), "stale": _count("stale_case_flag"),
     **_double("hours_to_first_response"), **_double("csat_score"),
     **_whole("days_to_resolution"), **_whole("interaction_count")},
    ("case_type", "n AS total_cases", "active AS active_cases", "active AS open_backlog",
     f"{round2_sql(_mean('hours_to_first_response'))} AS avg_hours_to_first_response",
     f"{round2_sql(_whole_mean('days_to_resolution'))} AS avg_days_to_resolution",
     f"{round2_sql(pct_sql('escalated', 'n'))} AS escalation_rate_pct",
     f"{round2_sql(pct_sql('reopened', 'closed'))} AS reopen_rate_pct",
     f"{round2_sql(pct_sql('late', 'n'))} AS sla_breach_rate_pct",
     f"{round2_sql(_whole_mean('interaction_count'))} AS avg_interactions_per_case",
     f"{round2_sql(_mean('csat_score'))} AS avg_csat", "stale AS stale_cases_count"))

BOTTLENECKS = Mart(
    ("analysis_type", "group_key"),
    {"n": "1L", "late": _count("sla_breach_flag"), **_double("csat_score"), **_whole("days_to_resolution")},
    marts.bottleneck_columns("n", _whole_mean("days_to_resolution"), _mean("csat_score"), pct_sql("late", "n")),
    "bottlenecks")

# Active cases per advocate; ``marts.caseload_of`` joins the advocates.
ACTIVE_CASES = Mart(
    ("advocate_id",),
    {"n": "1L", "active": _count(f"{marts.IS_ACTIVE} AND case_id IS NOT NULL")},
    ("advocate_id", "active"))


def fact_changes(old: DataFrame, new: DataFrame, key: str = "case_id") -> DataFrame:
    """Rows to take out (``__sign`` -1) and to put in (+1) to get from ``old`` to ``new``.

    Cases are compared by a 128-bit digest of their rows, counted with their
    sign: only the digests are shuffled, not the wide rows.  The cases that
    differ then fetch their rows; when few do, adaptive execution broadcasts
    them.  A null key is a case of its own.
    """
    columns = ", ".join(f"`{c}`" for c in new.columns)

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.selectExpr(f"`{key}`", f"xxhash64({columns}) AS h1", f"xxhash64('second', {columns}) AS h2",
                             f"{sign}L AS {SIGN}")

    old = old.select(*new.columns)
    differ = (
        signed(old, -1).union(signed(new, 1)).groupBy(key, "h1", "h2").agg(F.sum(SIGN).alias("n"))
        .where("n <> 0").select(F.col(key).alias("__key")).distinct()
    )
    both = old.withColumn(SIGN, F.lit(-1).cast("bigint")).union(new.withColumn(SIGN, F.lit(1).cast("bigint")))
    return both.join(differ, F.expr(f"`{key}` <=> __key"), "left_semi")


def maintain(mart: Mart, state: DataFrame, changes: DataFrame) -> DataFrame:
    """The state after the fact's changes."""
    return mart.merge(state, mart.state(changes))
