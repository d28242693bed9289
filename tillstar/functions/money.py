"""Exact decimal arithmetic: money never passes through binary floating point."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def cents(c: Column) -> Column:
    """A two-digit decimal as a whole number of cents."""
    return (c.cast("decimal(18,2)") * 100).cast("bigint")


def sum_money(c: Column) -> Column:
    """Sum of a money column, added up as 64-bit cents.

    A long sum stays in generated code with a primitive buffer, which a decimal(28,2) sum does
    not. Cents in a long hold up to 92 quadrillion whole units; ANSI mode raises beyond that.
    """
    return from_cents(F.sum(cents(c)))


def from_cents(c: Column) -> Column:
    return (c.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def ratio(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` rounded half up to ``digits``; NULL when ``den`` is 0 or NULL.

    Both sides hold at most two fraction digits. The quotient is taken on whole numbers, so it is
    rounded once: a plain decimal division is itself rounded before ``round`` sees it.
    """
    n = (num.cast("decimal(30,2)") * 100).cast("decimal(32,0)")
    d = (den.cast("decimal(26,2)") * 100).cast("decimal(28,0)")
    twice = F.nullif(F.abs(d) * 2, F.lit(Decimal(0)))
    scaled = F.call_function("div", F.abs(n) * F.lit(Decimal(2 * 10**digits)) + F.abs(d), twice)
    signed = F.when((n < 0) != (d < 0), -scaled).otherwise(scaled)
    step = Decimal(1).scaleb(-digits)
    return (signed.cast("decimal(19,0)") * F.lit(step)).cast(f"decimal(18,{digits})")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return ratio(part.cast("decimal(28,2)") * 100, whole, digits)


def growth(new: Column, old: Column, digits: int = 2) -> Column:
    """Percentage change from ``old`` to ``new``."""
    return percent(new - old, old, digits)


def amount(unit_price: Column, quantity: Column) -> Column:
    return F.round(unit_price * quantity, 2).cast("decimal(18,2)")


def differs(a: Column, b: Column, tolerance: str = "0.01") -> Column:
    return F.abs(a - b) > F.lit(Decimal(tolerance))
