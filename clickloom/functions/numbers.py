"""Rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_half_up(part: Column, whole: Column, scale: int = 2) -> Column:
    """``part / whole`` rounded half up to ``scale`` decimals, as double.

    Both are non-negative integers. The rounding is done on the exact fraction in
    integers, so a tie such as 57/200 always goes up. Null when ``whole`` is 0.
    """
    unit = 10**scale
    rounded = F.call_function(
        "div", F.lit(2 * unit).cast("bigint") * part + whole, F.lit(2).cast("bigint") * whole
    )
    return F.when(whole > 0, rounded / F.lit(float(unit)))


def round_half_up(c: Column, scale: int) -> Column:
    """A double rounded half up (away from zero) at ``scale`` decimals by its exact value.

    0.285 is stored a little below 0.285, so it gives 0.28. ``F.round`` decides on the
    shortest decimal notation instead and gives 0.29. A value that has no digit beyond
    ``scale`` decimals, an infinity and NaN stay as they are.
    """
    unit = float(10**scale)
    size = F.abs(c.cast("double"))
    scaled = size * unit
    # scaled + missed is the exact product (Dekker's two-product)
    high, low = _halves(size)
    unit_high, unit_low = _halves(F.lit(unit))
    missed = (
        (high * unit_high - scaled) + high * unit_low + low * unit_high
    ) + low * unit_low
    whole = F.floor(scaled).cast("double")
    fraction = scaled - whole
    # from 2^52 on the product is stored as a whole number and only the miss has a half
    up = (fraction > 0.5) | ((fraction == 0.5) & (missed >= 0.0)) | (missed >= 0.5)
    rounded = (whole + up.cast("int")) / unit
    # from 2^53 on the nearest double to the result is the value; NaN is above every number
    return (
        F.when(scaled >= 2.0**53, c.cast("double"))
        .when(c < 0, -rounded)
        .otherwise(rounded)
    )


def _halves(c: Column) -> tuple[Column, Column]:
    """A double as the sum of two that have half of its digits each."""
    shifted = c * 134217729.0  # 2^27 + 1
    high = shifted - (shifted - c)
    return high, c - high
