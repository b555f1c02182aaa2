"""Period texts such as ``2 months`` and the shifts they stand for."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTHS = {"month": 1, "months": 1, "year": 12, "years": 12}
_SECONDS = {
    "week": 604_800, "weeks": 604_800, "day": 86_400, "days": 86_400, "hour": 3_600, "hours": 3_600,
    "minute": 60, "minutes": 60, "second": 1, "seconds": 1,
}


@dataclass(frozen=True)
class Period:
    """A number of calendar months, or a fixed number of seconds."""

    months: int = 0
    seconds: int = 0

    def __neg__(self) -> Period:
        return Period(-self.months, -self.seconds)


def parse_period(text: str) -> Period:
    """``'<whole number> <unit>'``; anything else is a ValueError."""
    words = text.lower().split()
    if len(words) != 2:
        raise ValueError(f"period {text!r} is not of the form '<number> <unit>'")
    amount, unit = int(words[0]), words[1]
    if unit in _MONTHS:
        return Period(months=amount * _MONTHS[unit])
    if unit in _SECONDS:
        return Period(seconds=amount * _SECONDS[unit])
    raise ValueError(f"period {text!r} has the unknown unit {unit!r}")


def shift(moment: datetime, period: Period) -> datetime:
    """Move a moment; a day that the target month lacks becomes the month's last day."""
    index = moment.year * 12 + moment.month - 1 + period.months
    year, month = divmod(index, 12)
    day = min(moment.day, calendar.monthrange(year, month + 1)[1])
    return moment.replace(year=year, month=month + 1, day=day) + timedelta(seconds=period.seconds)


def midnight(day: date) -> datetime:
    return datetime.combine(day, time())


def first_day_from(moment: datetime) -> date:
    """First calendar day that starts at or after a moment: the bound to use on date columns."""
    return moment.date() if moment == midnight(moment.date()) else moment.date() + timedelta(days=1)


def shift_column(column: Column, period: Period) -> Column:
    """The same move on a date column; whole days keep it a date, shorter steps give a timestamp."""
    if period.months:
        column = F.add_months(column, period.months)
    if not period.seconds:
        return column
    days, rest = divmod(period.seconds, 86_400)
    if not rest:
        return F.date_add(column, days)
    return column.cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(period.seconds))
