"""The calendar: one row per day that occurs in the climate table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.functions import calendar as cal


def distinct_days(df: DataFrame, date: str = "date") -> DataFrame:
    return df.select(date).distinct()


def mark_holidays(days: DataFrame, holidays: DataFrame | Iterable[str] = cal.BRAZIL_HOLIDAYS_2023) -> DataFrame:
    """Add ``is_feriado``. Holidays are a few literal dates or a table with a ``date`` column."""
    if not isinstance(holidays, DataFrame):
        return days.withColumn("is_feriado", F.col("date").isin([F.lit(text).cast("date") for text in holidays]))
    # no hint: the caller's table may be of any size, and the planner broadcasts it only if it is small
    marks = holidays.select("date").distinct().withColumn("_marked", F.lit(True))
    return (
        days.join(marks, "date", "left")
        .withColumn("is_feriado", F.col("_marked").isNotNull())
        .drop("_marked")
    )


def calendar_table(
    days: DataFrame,
    holidays: DataFrame | Iterable[str] = cal.BRAZIL_HOLIDAYS_2023,
    long_first: bool = False,
) -> DataFrame:
    """Calendar attributes of a table of distinct days.

    ``day_of_week_name`` holds the number of the weekday, not its name, as users of the table
    expect. ``long_first`` lets the label of a long holiday win over the plain one.
    """
    holiday = F.col("is_feriado")
    return mark_holidays(days, holidays).select(
        "date",
        cal.month("date").alias("month"),
        cal.week_of_year("date").alias("week_of_year"),
        cal.day_of_week("date").alias("day_of_week"),
        cal.day_of_year("date").alias("day_of_year"),
        cal.is_weekend("date").alias("is_final_semana"),
        cal.season("date").alias("estacao"),
        holiday,
        cal.is_long_holiday("date", holiday).alias("is_feriado_prolongado"),
        cal.holiday_type(holiday, cal.is_long_holiday("date", holiday), long_first).alias("tipo_feriado"),
        (~(cal.is_weekend("date") | holiday)).alias("is_dia_util"),
        cal.day_of_week("date").alias("day_of_week_name"),
    )
