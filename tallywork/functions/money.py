"""Exact money and percentage expressions (decimal in, decimal out)."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, functions as F

# Reporting rates to USD; any other currency counts as 1.0.
FIXED_RATES: dict[str, Decimal] = {"GBP": Decimal("1.27"), "EUR": Decimal("1.08")}
# Markets that trade in USD and GBP only.
GBP_ONLY: dict[str, Decimal] = {"GBP": Decimal("1.27")}

# Quotients of this type keep twelve decimals however wide the sums are that go in.
_OPERAND = "decimal(26,6)"


def fx_rate(currency: Column, rates: Mapping[str, Decimal] = FIXED_RATES) -> Column:
    """Rate to the reporting currency, as a column that can be kept for audit."""
    rate = None
    for code, value in rates.items():
        rate = (F if rate is None else rate).when(currency == code, F.lit(value))
    one = F.lit(Decimal("1.0"))
    return one if rate is None else rate.otherwise(one)


def to_usd(amount: Column, currency: Column, rates: Mapping[str, Decimal] = FIXED_RATES) -> Column:
    return amount * fx_rate(currency, rates)


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """Percentage of exact numbers, rounded half up; NULL when the denominator is zero or NULL.

    Both sides are brought to a fixed width first: dividing two wide sums would leave six
    decimals, and rounding those again turns 5.7549998 into 5.76.
    """
    hundredfold = (num.cast(_OPERAND) * F.lit(100)).cast(_OPERAND)
    return F.round(hundredfold / F.nullif(den.cast(_OPERAND), F.lit(0)), digits)


def pct0(num: Column, den: Column, digits: int = 2) -> Column:
    """Percentage, 0 unless the denominator is positive."""
    return F.when(den > 0, pct(num, den, digits)).otherwise(F.lit(0))
