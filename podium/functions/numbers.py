"""Numeric column functions (N13-N15, N18) and exact-sum helpers.

All are native column expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, decimals: int = 2) -> Column:
    """Round half away from zero on the scaled binary value.

    ``round(x * 10^d, 0) / 10^d`` rather than ``round(x, d)``: the plain form rounds
    the shortest decimal text of the double (1.005 -> 1.01), the scaled form rounds
    the stored double (1.005 -> 1.0) like most engines do; 90.625 -> 90.63 either way.
    """
    scale = float(10 ** decimals)
    return F.round(_c(c) * F.lit(scale), 0) / F.lit(scale)


def to_units(c, decimals: int = 6) -> Column:
    """Scaled integer units (e.g. micro-points) of a double, for exact sums."""
    return F.round(_c(c) * F.lit(float(10 ** decimals)), 0).cast("bigint")


def exact_sum(c, decimals: int = 6) -> Column:
    """Sum of doubles that does not depend on the order of addition."""
    return F.sum(to_units(c, decimals)) / F.lit(float(10 ** decimals))


def first_int(c) -> Column:
    """First run of digits as a long: '1st M' -> 1, 'Male (12)' -> 12, 'Male (*)' -> null."""
    digits = F.regexp_extract(_c(c), r"(\d+)", 1)
    return F.when(digits != "", digits).try_cast("bigint")


def lenient_int(c) -> Column:
    """Trim, then cast to long; null when the text is not an integer."""
    return F.trim(_c(c)).try_cast("bigint")


def clock_seconds(c) -> Column:
    """Clock text to seconds: 'h:mm:ss[.f]', 'mm:ss[.f]' or 'ss[.f]' (base-60 fold)."""
    parts = F.split(F.trim(_c(c)), ":")
    return F.aggregate(
        parts, F.lit(0.0),
        lambda acc, x: acc * F.lit(60.0) + F.trim(x).try_cast("double"),
    )


def step_bonus(n, steps) -> Column:
    """Cumulative step incentive: sum of the values of all steps whose threshold n reaches."""
    n = _c(n)
    total = F.lit(0.0)
    for threshold, value in steps:
        total = total + F.when(n >= F.lit(threshold), F.lit(float(value))).otherwise(F.lit(0.0))
    return total
