"""Column expressions shared by the operators. All of them are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is NULL, not an ANSI error, when the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def pct_change(value: Column, previous: Column, *, signed_base: bool = False) -> Column:
    """100 * (value - previous) / previous; ``signed_base`` divides by ``abs(previous)``.

    The absolute base keeps the sign of the result equal to the direction of the change for
    quantities that may be negative, such as complexity indices.
    """
    base = F.abs(previous) if signed_base else previous
    return ratio(F.lit(100.0) * (value - previous), base)


def decimals_text(value: Column, digits: int) -> Column:
    """``value`` with a fixed number of decimals, the exact binary value rounded, ties to even.

    Whole and fractional part are separated without error. The fraction times twice the scale is
    taken as a product and its rounding error, so that its place against the tie is exact.
    """
    scale = 10**digits
    size = F.abs(value)
    whole = F.floor(size).cast("double")
    fraction = size - whole
    double = fraction * F.lit(2.0 * scale)
    # The upper 26 bits of the fraction, so that both partial products are exact.
    upper = fraction * F.lit(134217729.0) - (fraction * F.lit(134217729.0) - fraction)
    error = (upper * F.lit(2.0 * scale) - double) + (fraction - upper) * F.lit(2.0 * scale)
    below = F.floor(double / F.lit(2.0))
    past_tie = (double - (below * 2 + 1)) + error
    up = (past_tie > 0) | ((past_tie == 0) & (below % 2 == 1))
    units = below + F.when(up, 1).otherwise(0)
    carried = units >= scale
    integer = whole.cast("long") + F.when(carried, 1).otherwise(0)
    rest = F.when(carried, units - scale).otherwise(units).cast("string")
    sign = F.when(value.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    text = F.concat(sign, integer.cast("string"), F.lit("."), F.lpad(rest, digits, "0"))
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(size == float("inf"), F.concat(sign, F.lit("inf")))
        # Beyond whole numbers of 64 bits there is no fraction.
        .when(size >= 2.0**63, F.format_string(f"%.{digits}f", value))
        .when(value.isNotNull(), text)
    )


def percent_text(value: Column) -> Column:
    """The value times 100, with one decimal."""
    return F.concat(decimals_text(value * F.lit(100.0), 1), F.lit("%"))


def fixed_text(value: Column) -> Column:
    return decimals_text(value, 2)


def quartile_text(quartile: Column) -> Column:
    return F.concat(F.lit("Q"), quartile.cast("string"))


def label_of(code: Column, labels: dict[str, str]) -> Column:
    """Map codes to labels; a code without a label gives NULL."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), code)


def tier_of(quartile: Column) -> Column:
    return (
        F.when(quartile == 4, S.HIGH)
        .when(quartile == 3, S.MEDIUM_HIGH)
        .when(quartile == 2, S.MEDIUM_LOW)
        .otherwise(S.LOW)
    )
