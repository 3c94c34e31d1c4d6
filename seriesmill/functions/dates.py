"""Calendar columns used by the profiles and the forecast."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def weekday_index(date: Column) -> Column:
    """Sunday is 1, Friday is 6 and Saturday is 0, so Saturday sorts first."""
    return F.dayofweek(date) % 7


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def horizon(last: Column, h: int) -> Column:
    """The ``h`` days that follow ``last``, as an array of dates."""
    return F.sequence(F.date_add(last, 1), F.date_add(last, h))


def date_range(start: dt.date | str, end: dt.date | str) -> list[dt.date]:
    """Every day from ``start`` up to, but without, ``end``."""
    first, stop = as_date(start), as_date(end)
    return [first + dt.timedelta(days=n) for n in range((stop - first).days)]
