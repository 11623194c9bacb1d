"""Exact sums and means of money and percent columns.

The tables hold DOUBLE amounts. Adding doubles gives a last digit that depends on the order of the
rows, so a rounded total could change between two runs of one job. Amounts are therefore added as
decimals with eight digits after the point: the decimal of the fewest digits that reads as the same double. For whole
cents that is found by arithmetic, for other amounts with 15, 16 and 17 digits in turn, as Java before 19 prints
some large doubles with more digits than they need. Partial sums still combine on the map side.

Silver keeps amounts below ``LIMIT`` only. A total may have 30 digits before the point, which is room for
10^12 amounts of that size; beyond it the query fails and nothing is cut.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,8)"
LIMIT = 1e18


def _column(amount: str | Column) -> Column:
    return F.col(amount) if isinstance(amount, str) else amount


def addable(number: Column) -> Column:
    """The number, or NULL where it is not a number, infinite or too large to be added."""
    return F.when(F.abs(number) < LIMIT, number)


def exact(amount: str | Column) -> Column:
    """The amount as a decimal."""
    number = _column(amount)
    cents = F.rint(number * 100)
    whole = (cents.cast("long").cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(MONEY)
    short, longer = (F.format_string(f"%.{digits}e", number) for digits in (14, 15))
    return (
        F.when((F.abs(number) < 9e13) & (cents / 100 == number), whole)
        .when(number.isNull(), None)
        .when(short.try_cast("double") == number, short.try_cast(MONEY))
        .when(longer.try_cast("double") == number, longer.try_cast(MONEY))
        .otherwise(number.cast(MONEY))
    )


def exact_total(amount: str | Column) -> Column:
    """Sum of a money column as a decimal."""
    return F.sum(exact(amount))


def total(amount: str | Column) -> Column:
    return exact_total(amount).cast("double")


def rounded_total(amount: str | Column, digits: int = 2) -> Column:
    return F.round(exact_total(amount), digits).cast("double")


def _count(amount: str | Column) -> Column:
    return F.nullif(F.count(_column(amount)), F.lit(0))


def mean(amount: str | Column) -> Column:
    """Unrounded mean: the exact sum divided once."""
    return total(amount) / _count(amount)


def rounded_mean(amount: str | Column, digits: int = 2) -> Column:
    """Mean rounded once."""
    return rounded_share(exact_total(amount), _count(amount), digits)


def rounded_share(whole: Column, rows: Column, digits: int = 2) -> Column:
    """A total by its rows. A quotient keeps the digits that its whole part leaves: twelve, or eight from 10^26 on."""
    usual = F.round(whole.try_cast("decimal(34,8)") / rows, digits).cast("double")
    return F.coalesce(usual, F.round(whole / rows, digits).cast("double"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` of ``whole`` in percent; NULL when there is nothing to divide by."""
    return F.round(part / F.nullif(whole, F.lit(0)) * 100, digits)
