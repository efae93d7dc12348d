"""Rounding and sums that do not depend on row order, partitioning or a retried task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts below this are added as decimals; a sum of 1e11 of them still fits.
_DECIMAL_LIMIT = "1e19D"

# Units up to which doubles are rounded without decimals, and how far from a tie: their error there is below 1e-6, and the
# ten places of the decimal are at most 1e-4 of a unit.
_PLAIN_UNITS, _NEAR_TIE = 1e9, 1e-3


def exact_sum(name: str) -> Column:
    """Sum of a column as a double, the same to the last digit for every row order, partitioning or retried task.

    Values are added as decimals with eight places, which widen to 38 digits. NaN, infinite and absurdly large values
    (from 1e19) have no such decimal; they are added as doubles on top, so that they show in the sum.
    """
    amount = f"cast({name} as double)"
    usual = f"abs({amount}) < {_DECIMAL_LIMIT}"
    exact = f"cast(sum(case when {usual} then cast({amount} as decimal(28,8)) end) as double)"
    rest = f"sum(case when not ({usual}) then {amount} end)"
    return F.expr(f"case when {rest} is null then {exact} else coalesce({exact}, 0D) + {rest} end")


def exact_avg(name: str) -> Column:
    return exact_sum(name) / F.expr(f"nullif(count({name}), 0)")


def round_half_up(value: Column, places: int = 2) -> Column:
    """Decimal rounding of a double. Beyond 1e18 doubles have no decimal places and stay as they are.

    Decimals decide near ties only. Elsewhere the nearest whole number of units is plain, and dividing it gives the double
    nearest to that decimal, which is the one that the decimal is cast to.
    """
    fixed = F.round(value.try_cast("decimal(28,10)"), places)
    exact = F.coalesce(fixed.cast("double"), value.cast("double"))
    if not 0 <= places <= 6:
        return exact
    units = value.cast("double") * F.lit(float(10**places))
    plain = (F.abs(units) < _PLAIN_UNITS) & (F.abs(units - F.floor(units) - 0.5) > _NEAR_TIE)
    return F.when(plain, F.floor(units + 0.5) / F.lit(float(10**places))).otherwise(exact)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Division that gives null for a zero divisor."""
    return top / F.nullif(bottom, F.lit(0.0))
