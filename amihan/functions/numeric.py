"""Exact rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``round(numerator / denominator, digits)``, half away from zero, exact.

    Decimal division in Spark keeps few digits, so rounding its result may
    round twice.  For whole numbers the rounded quotient is computed with
    integral division instead.  NULL for a zero denominator.
    """
    scaled = F.abs(numerator).cast("decimal(38,0)") * (2 * 10**digits)
    base = F.nullif(denominator.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    quotient = F.call_function("div", scaled + base, base * 2)
    signed = F.when(numerator < 0, -quotient).otherwise(quotient)
    return (signed.cast("decimal(28,0)") / (10**digits)).cast(f"decimal(28,{digits})")


def cents(amount: Column) -> Column:
    """An amount with two decimals as a whole number of cents."""
    return (amount * 100).cast("decimal(38,0)")
