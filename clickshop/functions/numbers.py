"""Arithmetic with fixed rounding, division and time-difference rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_SECOND = 1_000_000
SECOND, MINUTE, HOUR, DAY = 1, 60, 3_600, 86_400
# From here on doubles are whole numbers.
NO_FRACTION = 2.0**52
# Amounts below this are added as decimals of ten places.
DECIMAL_LIMIT = 1e18


def round_half_away(x: Column, digits: int) -> Column:
    """Round a double to ``digits`` places, halves away from zero.

    Written out as IEEE steps, so that any engine repeating them gets the same bits.
    A double that large that it holds no fraction of a unit, an infinity and NaN stay.
    """
    scale = 10.0**digits
    scaled = F.abs(x) * scale
    rounded = F.signum(x) * F.floor(scaled + 0.5) / scale + F.lit(0.0)
    return F.when(scaled < NO_FRACTION, rounded).otherwise(x)


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator / denominator`` rounded; NULL when the denominator is 0."""
    guarded = F.nullif(denominator, F.lit(0))
    return round_half_away(numerator.cast("double") / guarded, digits)


def exact_sum(x: Column) -> Column:
    """Sum of a double column that does not depend on the order of its rows.

    Money arrives as doubles.  Adding those in shuffle order gives totals whose
    last bits change from run to run, and differ again after a lost executor is
    replaced; decimal addition does not.  Ten decimals are kept, so an amount below
    5e-11 adds nothing.  As soon as one amount is NaN, infinite or 1e18 and more, no
    money total exists; the plain sum of the doubles then shows that.
    """
    plain = F.abs(x) < DECIMAL_LIMIT
    exact = F.sum(F.when(plain, x).cast("decimal(38,10)")).cast("double")
    return F.when(F.bool_or(~plain), F.sum(x)).otherwise(exact)


def whole_units(later: Column, earlier: Column, seconds: int) -> Column:
    """Whole units of ``seconds`` between two epoch-microsecond columns.

    Truncated toward zero, and independent of the session time zone.
    """
    step = F.lit(seconds * MICROS_PER_SECOND)
    return F.call_function("div", later - earlier, step)
