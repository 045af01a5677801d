"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(aggregate: Column, digits: int = 2) -> Column:
    return F.round(aggregate, digits)


def rounded_average(column: Column, digits: int = 2) -> Column:
    return steady(F.avg(column), digits)


def steady(value: Column, digits: int) -> Column:
    """Rounded in two steps.

    The last digits of a sum of doubles depend on the order of the rows. The
    first step takes them off, so a tie rounds the same way on every run.
    """
    return F.round(F.round(value, digits + 6), digits)


def rounded_ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """A ratio of whole numbers as a double, rounded once, halves away from zero; NULL when there is no whole.

    The division is one of whole numbers, so no digit is lost before the rounding.
    """
    part, whole = part.cast("decimal(28,0)"), whole.cast("decimal(18,0)")
    doubled = F.abs(part) * F.lit(2 * 10**digits).cast("decimal(9,0)")
    steps = F.call_function("div", doubled + whole, whole * F.lit(2).cast("decimal(1,0)"))
    return F.when(whole > 0, F.signum(part.cast("double")) * steps.cast("double") / F.lit(float(10**digits)))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` of ``whole`` in percent, both whole numbers, as a double; NULL when there is no whole."""
    return rounded_ratio(part.cast("long") * 100, whole.cast("long"), digits)


def amount(cents: str) -> Column:
    """Whole cents as an amount of money."""
    return (F.col(cents).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(20,2)")


def quotient(total: Column, count: Column, digits: int = 2) -> Column:
    """Average put together from a summed total and a summed count."""
    return steady(F.try_divide(total.cast("double"), count), digits)
