"""Numeric column expressions.

Two rounding rules are in use. Data-frame style operators (cleaning, features,
statistics, charts) round half to even; the analytical query suite rounds half away
from zero. Both scale, round to an integer and scale back, so they stay inside
generated code and give the same double on every engine that does the same.

All divisions are guarded: with ANSI mode on, ``x / 0`` raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_DECIMAL = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_even(c: Column | str, digits: int) -> Column:
    scale = float(10**digits)
    return F.rint(_col(c) * scale) / scale


def round_half_up(c: Column | str, digits: int) -> Column:
    scale = float(10**digits)
    return F.round(_col(c) * scale) / scale


def as_number(c: Column | str) -> Column:
    """Double, with unparseable text and NaN turned into null."""
    number = _col(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def number_from_text(c: Column | str) -> Column:
    """Double from text that is a decimal number, white space around it ignored. All else is null,
    also what only a cast takes for a number (``1d``, ``1.5f``, names of infinity)."""
    return F.when(_col(c).rlike(_DECIMAL), as_number(c))


def ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``numerator * scale / denominator``; null when the denominator is 0 or null."""
    return F.try_divide(numerator * F.lit(scale), denominator)


def _share(numerator: Column | str, denominator: Column | str, multiplier: float) -> Column:
    top = F.coalesce(as_number(numerator), F.lit(0.0))
    bottom = as_number(denominator)
    return F.when(bottom > 0, F.try_divide(top, bottom) * F.lit(multiplier)).otherwise(F.lit(0.0))


def ratio_pct(numerator: Column | str, denominator: Column | str, digits: int = 4) -> Column:
    """Percentage in [0, 100]; 0 when the denominator is missing or not positive."""
    share = _share(numerator, denominator, 100.0)
    return round_even(F.least(F.greatest(share, F.lit(0.0)), F.lit(100.0)), digits)


def per_capita(
    metric: Column | str,
    population: Column | str,
    multiplier: float = 100_000.0,
    digits: int = 4,
) -> Column:
    """Metric per ``multiplier`` inhabitants; 0 when the population is missing or not positive."""
    return round_even(_share(metric, population, multiplier), digits)


def coverage_pct(covered: Column | str, population: Column | str, digits: int = 4) -> Column:
    """Covered share of the population in percent, clipped to [0, 100]."""
    return ratio_pct(covered, population, digits)
