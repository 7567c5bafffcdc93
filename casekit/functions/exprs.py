"""Column expressions with the reference's exact numeric semantics.

Every helper is a Spark SQL expression over column names (or other SQL
expression text) and returns a ``Column`` via one ``F.expr`` call; the
``*_sql`` variants return the text so helpers compose without extra JVM
round trips.  Everything stays inside whole-stage codegen.  The traps they

* ``round2``          – ROUND(double, 2) that scales, rounds and unscales (T2).
* ``hours_between``   – epoch seconds of a timestamp difference / 3600 (T3).
* ``hour_boundaries`` – hour difference counted in crossed hour boundaries (T1).
* ``days_between``    – calendar-date difference as BIGINT (T5).
* ``pct`` / ``ratio`` – floating percentages with a NULL-if-zero denominator (T4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Microseconds per day / per hour / per second.
MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_SECOND = 1_000_000
# Hour-aligned origin for boundary counting (any whole hour works).
EPOCH_TEXT = "1970-01-01 00:00:00"


def round2_sql(x: str) -> str:
    return f"(round(({x}) * 100D, 0) / 100D)"


def round2(x: str) -> Column:
    """ROUND(x, 2) on a double, reference style: round(x * 100) / 100.

    Spark's ``round(x, 2)`` rounds the decimal text of ``x`` (1.005 -> 1.01);
    the reference multiplies first (1.005 * 100 = 100.4999... -> 1.00).
    """
    return F.expr(round2_sql(x))


def micros_between_sql(start: str, end: str) -> str:
    """Exact microseconds from ``start`` to ``end`` (BIGINT)."""
    return f"timestampdiff(MICROSECOND, {start}, {end})"


def hours_between_sql(start: str, end: str) -> str:
    us = micros_between_sql(start, end)
    rest = f"({us} % {MICROS_PER_DAY})"
    return (
        f"(((({us} - {rest}) / {MICROS_PER_DAY}D) * 86400D"
        f" + {rest} / {float(MICROS_PER_SECOND)}D) / 3600D)"
    )


def hours_between(start: str, end: str) -> Column:
    """EXTRACT(EPOCH FROM end - start) / 3600.0 as the reference computes it.

    The interval is split into whole days and the rest; epoch seconds are
    ``days * 86400 + rest / 1e6``.  ``%`` keeps the sign of the dividend, as
    the interval's day and time parts do for negative spans.
    """
    return F.expr(hours_between_sql(start, end))


def _floor_hours_sql(ts: str) -> str:
    us = micros_between_sql(f"TIMESTAMP_NTZ '{EPOCH_TEXT}'", ts)
    return f"(({us} - pmod({us}, {MICROS_PER_HOUR})) div {MICROS_PER_HOUR})"


def hour_boundaries_sql(start: str, end: str) -> str:
    return f"({_floor_hours_sql(end)} - {_floor_hours_sql(start)})"


def hour_boundaries(start: str, end: str) -> Column:
    """DATE_DIFF('hour', start, end): number of hour boundaries crossed.

    10:59 -> 11:01 is 1 (Spark's ``timestampdiff(HOUR)`` would say 0).  Pure
    integer arithmetic on zone-less timestamps (floor division of exact
    microsecond offsets), so no session zone leaks in.
    """
    return F.expr(hour_boundaries_sql(start, end))


def days_between_sql(start: str, end: str) -> str:
    return f"CAST(datediff(CAST({end} AS DATE), CAST({start} AS DATE)) AS BIGINT)"


def days_between(start: str, end: str) -> Column:
    """DATE_DIFF('day', start::DATE, end::DATE) as BIGINT (calendar days)."""
    return F.expr(days_between_sql(start, end))


def count_where_sql(pred: str) -> str:
    return f"count_if({pred})"


def pct_sql(numerator: str, denominator: str) -> str:
    return f"(100D * ({numerator}) / nullif({denominator}, 0))"


def ratio_sql(numerator: str, denominator: str) -> str:
    return f"(({numerator}) * 1D / nullif({denominator}, 0))"


def blank_to_null_ts_sql(x: str, dtype: str = "string") -> str:
    if dtype in ("timestamp_ntz", "timestamp"):
        return f"CAST({x} AS TIMESTAMP_NTZ)"
    return (f"CASE WHEN trim(CAST({x} AS STRING)) = '' THEN NULL "
            f"ELSE CAST({x} AS TIMESTAMP_NTZ) END")


def int_flag_sql(x: str) -> str:
    return f"(CAST({x} AS INT) = 1)"


def text_to_int_sql(x: str) -> str:
    return f"try_cast(round(try_cast(trim({x}) AS DOUBLE), 0) AS INT)"


def text_to_int(x: str) -> Column:
    """Text number -> INTEGER the way the reference casts: '3', '3.0' -> 3, '3.7' -> 4.

    Unparseable text gives NULL instead of an error (callers default it).
    """
    return F.expr(text_to_int_sql(x))


def fmt_number_sql(x: str, decimals: int = 1, missing: str = "—") -> str:
    return f"coalesce(regexp_replace(format_number({x}, {decimals}), ',', ''), '{missing}')"


def fmt_number(x: str, decimals: int = 1, missing: str = "—") -> Column:
    """Number as text with fixed decimals, a dash for NULL.

    Python's ``f"{x:.1f}"`` rounds the exact binary value half-to-even;
    ``format_number`` (DecimalFormat, HALF_EVEN) does the same, whereas
    ``format_string('%.1f')`` rounds the shortest decimal text half-up
    (-9.95 -> -10.0).  Grouping separators are removed.
    """
    return F.expr(fmt_number_sql(x, decimals, missing))
