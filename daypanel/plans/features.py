"""The feature tables, each one lazy plan from readings, clients, climate and calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.operators.history import add_history

# The columns of the two tables in their order.
FEATURE_COLUMNS = [
    "date", "client_id", "total_consumption", "avg_temperature", "avg_humidity", "temp_humid_interaction",
    "day_counter", "consumption_lag_1", "consumption_lag_2", "consumption_lag_3", "consumption_lag_4",
    "consumption_lag_7", "consumption_lag_15", "rolling_mean_3", "rolling_std_3", "rolling_mean_7",
    "rolling_std_7", "diff_lag_1",
]
GLOBAL_COLUMNS = [*FEATURE_COLUMNS, "day_of_week_name", "month", "tipo_feriado"]


def readings_with_region(readings: DataFrame, clients: DataFrame) -> DataFrame:
    """Readings of known clients. No hint: the planner broadcasts clients only if they fit."""
    return readings.join(clients.select("client_id", "region"), "client_id")


def readings_with_climate(readings: DataFrame, clients: DataFrame, climate: DataFrame) -> DataFrame:
    """One row per reading and matching climate row; readings without climate stay."""
    return (
        readings_with_region(readings, clients)
        .join(climate.select("date", "region", "temperature", "humidity"), ["date", "region"], "left")
        .select(
            "date",
            "client_id",
            F.col("consumption_kwh").alias("total_consumption"),
            F.col("temperature").alias("avg_temperature"),
            F.col("humidity").alias("avg_humidity"),
            (F.col("temperature") * F.col("humidity")).alias("temp_humid_interaction"),
        )
    )


def feature_table(
    readings: DataFrame, clients: DataFrame, climate: DataFrame, long_keys: DataFrame | None = None, **options
) -> DataFrame:
    """Climate and history features of every reading.

    Readings move once, hashed by client: the client join and the windows share that layout.
    Several readings of a client on one day follow each other in order of their value.
    """
    rows = readings_with_climate(readings, clients, climate)
    order = ["date", "total_consumption"]
    return add_history(rows, order=order, long_keys=long_keys, **options).select(FEATURE_COLUMNS)


def global_table(features: DataFrame, calendar: DataFrame) -> DataFrame:
    """Features with calendar attributes; days missing from the calendar fall out.

    History is computed before, so a day that falls out still counts as its successors' past.
    """
    attributes = calendar.select("date", F.col("day_of_week").alias("day_of_week_name"), "month", "tipo_feriado")
    # one row per calendar day: the broadcast is as short as the calendar
    return features.join(F.broadcast(attributes), "date").select(GLOBAL_COLUMNS)
