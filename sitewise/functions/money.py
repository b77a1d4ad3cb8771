"""Exact money arithmetic on integer minor units.

Amounts with two decimals are summed as ``long`` cents: exact, independent
of summation order, and far cheaper than ``DECIMAL`` sums (which widen past
18 digits and fall back to arbitrary-precision arithmetic).  Convert once,
after the aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """A two-decimal amount (double or decimal) as integer cents."""
    return F.round(amount.cast("double") * 100).cast("long")


def from_cents(c: Column) -> Column:
    """Integer cents → DECIMAL(38,2)."""
    return (c.cast("decimal(38,0)") / 100).cast("decimal(38,2)")


def cents_to_double(c: Column) -> Column:
    """Integer cents → the double nearest to the exact amount."""
    return c.cast("double") / 100.0


def percent_units(rate: Column) -> Column:
    """A two-decimal rate (e.g. a discount 0.05) as integer hundredths."""
    return F.round(rate.cast("double") * 100).cast("long")
