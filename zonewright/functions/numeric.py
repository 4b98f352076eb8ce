"""Rounding and ratio helpers. All results are DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of money are taken over values of nine decimals, which add up to the same
# in any order. A double's sum depends on the order in its last bits.
MONEY = "decimal(18,9)"


# Sums of zones or fleets have no such bound: this holds them up to 1e29.
MONEY_TOTAL = "decimal(38,9)"


def money(x: Column) -> Column:
    """The amount of one delivery as it goes into a sum."""
    return x.cast(MONEY)


def money_total(x: Column) -> Column:
    """What is a sum already, as it goes into another one."""
    return x.cast(MONEY_TOTAL)


def round_half_away(x: Column, places: int) -> Column:
    """Round half away from zero on the scaled binary value.

    Spark's own ``round`` works on the decimal text of the number, so it gives
    1.01 for ``round(1.005, 2)`` where the binary value rounds to 1.0.
    """
    scale = float(10**places)
    x = x.cast("double")
    scaled = F.abs(x) * scale
    # The remainder by 1.0 is exact for doubles of any size; floor() would go
    # through BIGINT and saturate on fleet-wide sums.
    fraction = scaled % 1.0
    whole = scaled - fraction + F.when(fraction >= 0.5, 1.0).otherwise(0.0)
    return F.signum(x) * whole / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL on a zero divisor, as DOUBLE."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def pct(numerator: Column, denominator: Column) -> Column:
    """Percentage rounded to one place; NULL on a zero divisor."""
    return round_half_away(ratio(F.lit(100.0) * numerator.cast("double"), denominator), 1)
