from datetime import date, datetime, timedelta

import pytest

from daypanel.functions.periods import midnight, parse_period, shift, shift_column
from daypanel.operators.calendar_table import calendar_table
from pyspark.sql import functions as F


def rows_of(spark, days, **options):
    df = spark.createDataFrame([(d,) for d in days], "date date")
    return {row["date"]: row for row in calendar_table(df, **options).collect()}


def test_week_numbers_start_on_monday(spark):
    expected = {date(2023, 1, 1): 1, date(2023, 1, 2): 2, date(2024, 1, 1): 2, date(2024, 12, 31): 54}
    assert {d: r["week_of_year"] for d, r in rows_of(spark, expected).items()} == expected


def test_week_numbers_follow_strftime(spark):
    days = [date(1999, 1, 1) + timedelta(days=n) for n in range(3000)]
    assert all(r["week_of_year"] == int(d.strftime("%W")) + 1 for d, r in rows_of(spark, days).items())


def test_sunday_is_zero(spark):
    row = rows_of(spark, [date(2023, 1, 1)])[date(2023, 1, 1)]
    assert (row["day_of_week"], row["day_of_week_name"], row["is_final_semana"]) == (0, 0, True)


def test_season_edges(spark):
    expected = {
        date(2023, 3, 20): "Verao", date(2023, 3, 21): "Outono", date(2023, 6, 20): "Outono",
        date(2023, 6, 21): "Inverno", date(2023, 9, 20): "Inverno", date(2023, 9, 21): "Primavera",
        date(2023, 12, 20): "Primavera", date(2023, 12, 21): "Verao",
    }
    assert {d: r["estacao"] for d, r in rows_of(spark, expected).items()} == expected


def test_holidays(spark):
    thursday, other = date(2023, 9, 7), date(2023, 9, 8)
    rows = rows_of(spark, [thursday, other])
    assert rows[thursday]["is_feriado"] and rows[thursday]["is_feriado_prolongado"]
    assert rows[thursday]["tipo_feriado"] == "Feriado" and not rows[thursday]["is_dia_util"]
    assert rows[other]["tipo_feriado"] == "Nenhum" and rows[other]["is_dia_util"]
    assert rows_of(spark, [thursday], long_first=True)[thursday]["tipo_feriado"] == "Feriado Prolongado"


def test_holiday_table(spark):
    table = spark.createDataFrame([(date(2023, 9, 8),)] * 2, "date date")
    rows = rows_of(spark, [date(2023, 9, 7), date(2023, 9, 8)], holidays=table)
    assert [rows[d]["is_feriado"] for d in sorted(rows)] == [False, True]


@pytest.mark.parametrize("day, text, expected", [
    (date(2023, 1, 31), "1 month", datetime(2023, 2, 28)),
    (date(2023, 2, 28), "1 month", datetime(2023, 3, 28)),
    (date(2023, 2, 28), "-1 month", datetime(2023, 1, 28)),
    (date(2024, 2, 29), "1 year", datetime(2025, 2, 28)),
    (date(2023, 1, 1), "-1 months", datetime(2022, 12, 1)),
    (date(2023, 1, 1), "30 days", datetime(2023, 1, 31)),
    (date(2023, 1, 1), "2 weeks", datetime(2023, 1, 15)),
    (date(2023, 1, 1), "12 hours", datetime(2023, 1, 1, 12)),
])
def test_period_shift(spark, day, text, expected):
    period = parse_period(text)
    assert shift(midnight(day), period) == expected
    moved = spark.createDataFrame([(day,)], "d date").select(shift_column(F.col("d"), period).cast("timestamp_ntz").alias("m"))
    assert moved.first()["m"] == expected


@pytest.mark.parametrize("text", ["month", "1 2 3", "one month", "3 moons", ""])
def test_bad_periods(text):
    with pytest.raises(ValueError):
        parse_period(text)
