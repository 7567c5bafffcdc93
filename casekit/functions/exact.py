"""Sums and means of doubles that do not depend on the order of the rows.

A plain ``avg`` adds doubles in task order, so its last bits change with the
partitioning, and a rounded tie may flip.  Here every value is split into
signed integer limbs of 24 bits on a fixed grid (2^-96 up to 2^48); limbs are
added as integers, which is exact in any order, and the total is put together
once.  All of it is ordinary aggregate SQL: one pass, partial sums map-side,
and the limb sums can be stored, merged and subtracted.

A value with bits below 2^-96 (only those smaller than 1e-13 in size have any)
is first rounded to the grid, each by itself.  Values of 2^48 (2.8e14) or more,
infinities and NaN are added as doubles.  A limb sum holds 2^38 rows a group;
beyond that ANSI arithmetic fails rather than wraps.
"""

from __future__ import annotations

from casekit.functions.exprs import ratio_sql

LIMB_BITS = 24
LOWEST, HIGHEST = -4, 1  # limb k counts units of 2^(24 k)
LIMBS = list(range(HIGHEST, LOWEST - 1, -1))
_UNIT = 1 << LIMB_BITS


def _power(k: int) -> str:
    """2^(24 k) as a double literal (exact)."""
    return f"{float(2.0 ** (LIMB_BITS * k))!r}D"


def _fits(x: str) -> str:
    return f"abs(CAST({x} AS DOUBLE)) < {_power(HIGHEST + 1)}"


def limb_sql(x: str, k: int) -> str:
    """Limb ``k`` of ``x`` as BIGINT, with its sign; 0 where ``x`` does not fit,
    NULL where it is NULL."""
    size = f"abs(CAST({x} AS DOUBLE))"
    above = f"({size} / {_power(k + 1)})"
    part = f"(({above} % 1D) * {_UNIT}D)"  # the bits below limb k + 1: exact
    digit = f"rint({part})" if k == LOWEST else f"floor({part})"
    return f"CASE WHEN {_fits(x)} THEN CAST(signum({x}) AS BIGINT) * CAST({digit} AS BIGINT) WHEN {x} IS NOT NULL THEN 0L END"


def partial_sqls(x: str) -> dict[str, str]:
    """Row-level summands: add each of them up (they may be merged and
    subtracted), then use ``total_sql`` and ``mean_sql`` on the sums."""
    parts = {f"limb_{i}": limb_sql(x, k) for i, k in enumerate(LIMBS)}
    parts["large"] = f"CASE WHEN {_fits(x)} THEN 0D ELSE CAST({x} AS DOUBLE) END"
    parts["n"] = f"CASE WHEN {x} IS NOT NULL THEN 1L ELSE 0L END"
    return parts


def total_sql(sums: dict[str, str]) -> str:
    """The sum as a double, from the SQL of the summed parts.

    Carries are taken up first, so equal totals give equal digits however they
    were split; then three exact pieces are added, smallest first.
    """
    digits, carry = {}, "0L"
    for i in range(len(LIMBS) - 1, 0, -1):
        whole = f"({sums[f'limb_{i}']} + {carry})"
        digits[LIMBS[i]] = f"({whole} & {_UNIT - 1}L)"
        carry = f"shiftright({whole}, {LIMB_BITS})"
    top = f"(({sums['limb_0']} + {carry}) * {_UNIT}L + {digits[0]})"
    mid = f"(CAST({digits[-1]} * {_UNIT}L + {digits[-2]} AS DOUBLE) * {_power(-2)})"
    low = f"(CAST({digits[-3]} * {_UNIT}L + {digits[-4]} AS DOUBLE) * {_power(-4)})"
    return f"(CAST({top} AS DOUBLE) + ({mid} + {low}) + {sums['large']})"


def mean_sql(sums: dict[str, str]) -> str:
    return f"({total_sql(sums)} / nullif({sums['n']}, 0))"


def _sums(x: str) -> dict[str, str]:
    return {name: f"sum({part})" for name, part in partial_sqls(x).items()}


def exact_sum_sql(x: str) -> str:
    """SUM of a double column; NULL when no value is there."""
    sums = _sums(x)
    return f"CASE WHEN {sums['n']} > 0 THEN {total_sql(sums)} END"


def exact_avg_sql(x: str) -> str:
    """AVG of a double column; NULL when no value is there."""
    return mean_sql(_sums(x))


def int_avg_sql(x: str) -> str:
    """AVG of an integer column: the integer sum over the count."""
    return ratio_sql(f"sum({x})", f"count({x})")
