"""E19, E20, F10 over many clocks: how many cases are late, stale or open at
each of a series of times, in one pass over the fact.

Running the fact once per clock would scan it as often.  Here every fact row
says at which clock each of its flags begins (and, for open, ends): the flag's
condition solved for the time, as a number on the series.  Those +1 / -1 events
are counted per (group, clock) map-side, so at most a row per group, flag and
clock is shuffled, and running sums over the series give the counts.

The clock series is arithmetic (start, step, number).  ``late_cases`` and
``stale_cases`` are the fact's SLA-breach and stale flags had it been built with
that clock (on the rows as they are stored now); ``open_cases`` counts rows
created by the clock and not resolved by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.functions.exprs import MICROS_PER_HOUR, micros_between_sql
from casekit.operators.lifecycle import SLA_DAYS, STALE_HOURS

FLAGS = ["late", "stale", "open"]


def _first_clock(when: str, start: str, step: int) -> str:
    """Number of the first clock at or after ``when``; 0 if it is before all, NULL
    for NULL."""
    gap = micros_between_sql(start, when)
    number = f"({gap} + {step - 1}L - pmod({gap} + {step - 1}L, {step}L)) div {step}L"
    return f"CASE WHEN {when} IS NOT NULL THEN greatest(0L, {number}) END"


def late_from_sql(sla_days: int = SLA_DAYS) -> str:
    """When an unresolved row turns late: the midnight after its last day in time."""
    return f"CAST(date_add(CAST(created_at AS DATE), {sla_days + 1}) AS TIMESTAMP_NTZ)"


def stale_from_sql(stale_hours: int = STALE_HOURS) -> str:
    """When an unresolved row turns stale: the hour boundary that exceeds the
    limit, counted from the last touch or else the creation."""
    since = "coalesce(last_interaction_at, created_at)"
    return f"(date_trunc('HOUR', {since}) + make_dt_interval(0, {stale_hours + 1}))"


def flag_counts(fact: DataFrame, start: str, clocks: int, step_hours: int = 24, by: str = "case_type",
                sla_days: int = SLA_DAYS, stale_hours: int = STALE_HOURS) -> DataFrame:
    """(clock, <by>, late_cases, stale_cases, open_cases) for ``clocks`` times from
    ``start`` on, ``step_hours`` apart; a row per group and clock."""
    origin, step = f"TIMESTAMP_NTZ '{start}'", step_hours * MICROS_PER_HOUR
    late = (f"CASE WHEN resolved_at IS NOT NULL THEN if(days_to_resolution > {sla_days}, 0L, NULL) "
            f"ELSE {_first_clock(late_from_sql(sla_days), origin, step)} END")
    stale = f"CASE WHEN resolved_at IS NULL THEN {_first_clock(stale_from_sql(stale_hours), origin, step)} END"
    opened = _first_clock("created_at", origin, step)
    # Open until the first clock at or after the resolution.
    closed = f"CASE WHEN resolved_at >= created_at THEN {_first_clock('resolved_at', origin, step)} ELSE {opened} END"
    closed = f"CASE WHEN resolved_at IS NOT NULL THEN {closed} END"
    events = fact.selectExpr(by, "inline(array("
                             f"named_struct('flag', 'late', 'i', {late}, 'd', 1L),"
                             f"named_struct('flag', 'stale', 'i', {stale}, 'd', 1L),"
                             f"named_struct('flag', 'open', 'i', {opened}, 'd', 1L),"
                             f"named_struct('flag', 'open', 'i', {closed}, 'd', -1L)))")
    groups = fact.groupBy(by).agg(F.lit(0).alias("none")).drop("none")
    # A group's series is ``clocks`` rows, whatever the fact's size.
    series = groups.selectExpr(by, f"explode(sequence(0L, {clocks - 1}L)) AS i")
    zero = series.selectExpr(by, "'open' AS flag", "i", "0L AS d")
    counted = events.where(f"i < {clocks}").groupBy(by, "flag", "i").agg(F.sum("d").alias("d"))
    steps = counted.union(zero).groupBy(by, "i").agg(*[
        F.expr(f"sum(if(flag = '{f}', d, 0L)) AS {f}") for f in FLAGS])
    running = f"OVER (PARTITION BY {by} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return steps.selectExpr(
        f"{origin} + make_dt_interval(0, cast(i * {step_hours} as int)) AS clock", by,
        *[f"sum({f}) {running} AS {f}_cases" for f in FLAGS])
