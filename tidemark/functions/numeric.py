"""Exact integer and decimal arithmetic on columns.

Fractional measures are held as BIGINT minor units (``scale`` decimals), so
sums, steps and products are exact and independent of row order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(value: Column, divisor: Column) -> Column:
    """Integer division rounding towards minus infinity (divisor > 0)."""
    return int_div(value - F.pmod(value, divisor), divisor)


def int_div(value: Column, divisor: Column) -> Column:
    return F.call_function("div", value, divisor)


def half_up_div(value: Column, divisor: Column) -> Column:
    """Nearest integer to value / divisor, ties away from zero (divisor > 0)."""
    magnitude = int_div(F.abs(value) * 2 + divisor, divisor * 2)
    return F.when(value < 0, -magnitude).otherwise(magnitude)


def to_units(value: Column, scale: int) -> Column:
    """A FLOAT or DOUBLE measure as BIGINT minor units.

    The product with a power of ten up to 10**9 is exact for every FLOAT.
    """
    return F.rint(value.cast("double") * F.lit(float(10**scale))).cast("bigint")


def decimal_units(value: Column, scale: int) -> Column:
    """As ``to_units`` for a DECIMAL column, without passing through binary."""
    return (F.round(value, scale) * F.lit(10**scale)).cast("bigint")


def from_units(units: Column, scale: int, places: int = 2) -> Column:
    """Minor units rounded half-up to ``places`` decimals, as DOUBLE."""
    if scale > places:
        kept = half_up_div(units, F.lit(10 ** (scale - places)))
    else:
        kept = units * F.lit(10 ** (places - scale))
    return kept.cast("double") / F.lit(float(10**places))


def product_units(left: Column, right: Column, scale: int) -> Column:
    """Product of two minor-unit columns, in units of ``2 * scale`` decimals.

    Beyond two decimals the product can leave the BIGINT range, so it is
    carried as DECIMAL.
    """
    if scale <= 2:
        return left * right
    return left.cast("decimal(19,0)") * right.cast("decimal(19,0)")


def ratio6(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator to six decimals, 0.0 where the divisor is 0.

    Both sides are integers in the same unit, so the tie at the seventh
    decimal is decided exactly. A ratio too large for a DOUBLE to hold six
    decimals is divided as is.
    """
    plain = numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")
    top = numerator.cast("decimal(31,0)") * F.lit(10**6)
    bottom = F.nullif(F.abs(denominator), F.lit(0)).cast("decimal(31,0)")
    millionths = half_up_div(top, bottom)
    signed = F.when(denominator < 0, -millionths).otherwise(millionths)
    return (
        F.when(denominator == 0, F.lit(0.0))
        .when(F.abs(plain) > F.lit(float(2**53 // 10**6)), plain)
        .otherwise(signed.cast("double") / F.lit(1e6))
    )


def rounded(value: Column, places: int) -> Column:
    """A FLOAT rounded to ``places`` decimals, as DOUBLE; exact ties go to even."""
    return F.bround(value.cast("double"), places)
