"""Calendar attributes of a day as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on exactly these dates and labels.
BRAZIL_HOLIDAYS_2023 = [
    "2023-01-01", "2023-04-21", "2023-05-01", "2023-09-07",
    "2023-10-12", "2023-11-02", "2023-11-15", "2023-12-25",
]
SUMMER, AUTUMN, WINTER, SPRING = "Verao", "Outono", "Inverno", "Primavera"
HOLIDAY, LONG_HOLIDAY, NO_HOLIDAY = "Feriado", "Feriado Prolongado", "Nenhum"
# Mondays, Tuesdays, Thursdays and Fridays, with Sunday as 0.
LONG_WEEKEND_DAYS = [1, 2, 4, 5]


def month(day: str) -> Column:
    return F.month(day).cast("bigint")


def day_of_week(day: str) -> Column:
    """Sunday is 0, Saturday is 6."""
    return (F.dayofweek(day) - 1).cast("bigint")


def day_of_year(day: str) -> Column:
    return F.dayofyear(day).cast("bigint")


def week_of_year(day: str) -> Column:
    """Weeks start on Monday; days before the first Monday are week 1. Not the ISO week."""
    return F.expr(f"(dayofyear({day}) + 6 - weekday({day})) div 7 + 1").cast("bigint")


def month_day(day: str) -> Column:
    """Month and day as one number, 1225 for Christmas."""
    return F.month(day) * 100 + F.dayofmonth(day)


def season(day: str) -> Column:
    """Season of the southern hemisphere, turning on the 21st."""
    position = month_day(day)
    return (
        F.when(position.between(321, 620), AUTUMN)
        .when(position.between(621, 920), WINTER)
        .when(position.between(921, 1220), SPRING)
        .otherwise(SUMMER)
    )


def is_weekend(day: str) -> Column:
    return F.dayofweek(day).isin(1, 7)


def is_long_holiday(day: str, holiday: Column) -> Column:
    return holiday & day_of_week(day).isin(LONG_WEEKEND_DAYS)


def holiday_type(holiday: Column, long_holiday: Column, long_first: bool = False) -> Column:
    """Label of a day. By default the plain label wins, so the long one never shows."""
    ranked = [(holiday, HOLIDAY), (long_holiday, LONG_HOLIDAY)]
    if long_first:
        ranked.reverse()
    (first, first_label), (second, second_label) = ranked
    return F.when(first, first_label).when(second, second_label).otherwise(NO_HOLIDAY)
