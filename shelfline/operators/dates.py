"""Days and times: what "today" stands for, and times in several spellings."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


# The spellings a time may come in beside the ISO ones, in the order they are tried.
SPELLINGS = (
    "yyyy/MM/dd[ HH:mm[:ss]]",
    "dd.MM.yyyy[ HH:mm[:ss]]",
    "d MMM yyyy[ HH:mm[:ss]]",
    "MMM d, yyyy[ HH:mm[:ss]]",
    "MM/dd/yyyy[ HH:mm[:ss]]",
    "yyyyMMdd[ HHmmss]",
)


def _may_be(text: Column, spelling: str) -> Column:
    """Whether a text has the marks of a spelling, or only digits where there are none: a failed reading costs far more."""
    marks = sorted({mark for mark in spelling.split("[")[0] if not mark.isalpha()})
    if not marks:
        return text.rlike(r"^[\d +-]+$")
    return reduce(Column.__and__, [text.contains(mark) for mark in marks])


def read_time(text: Column) -> Column:
    """A time in any of the known spellings; NULL where it is in none of them."""
    plain = F.trim(text.cast("string"))
    # Eight digits would be cast as a year of eight digits.
    iso = F.when(~plain.rlike(r"^\d{5,}"), plain.try_cast("timestamp"))
    return F.coalesce(iso, *[F.when(_may_be(plain, s), F.try_to_timestamp(plain, F.lit(s))) for s in SPELLINGS])


def today(as_of: dt.date | None) -> Column:
    """A pinned day, or the current date of the query."""
    return F.current_date() if as_of is None else F.lit(as_of)


def in_month_of(day: str, as_of: dt.date | None) -> Column:
    """The calendar month of ``as_of`` as a plain range of days, which a Parquet scan can use."""
    first = F.trunc(today(as_of), "month")
    return (F.col(day) >= first) & (F.col(day) < F.add_months(first, 1))
