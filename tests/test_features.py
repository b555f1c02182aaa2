from datetime import date, timedelta

import pytest

from daypanel.operators import views
from daypanel.operators.calendar_table import calendar_table, distinct_days
from daypanel.plans.features import feature_table, global_table, readings_with_climate
from daypanel.sources.tables import CLIENT_SCHEMA, CLIMATE_SCHEMA, READING_SCHEMA, replace_view

START = date(2024, 1, 1)
CLIENTS = [("a", "Norte"), ("b", "Desconhecida"), ("c", None)]


def at(day):
    return START + timedelta(days=day)


def tables_of(spark, readings, climate):
    return (
        spark.createDataFrame([(at(d), c, y) for d, c, y in readings], READING_SCHEMA),
        spark.createDataFrame(CLIENTS, CLIENT_SCHEMA),
        spark.createDataFrame([(at(d), r, t, h) for d, r, t, h in climate], CLIMATE_SCHEMA),
    )


def test_unknown_clients_go_and_missing_climate_stays(spark):
    rows = readings_with_climate(*tables_of(
        spark, [(0, "a", 1.0), (0, "b", 2.0), (0, "c", 3.0), (0, "nobody", 4.0)], [(0, "Norte", 20.0, 50.0), (0, None, 1.0, 1.0)]
    )).collect()
    found = {r["client_id"]: (r["avg_temperature"], r["temp_humid_interaction"]) for r in rows}
    assert found == {"a": (20.0, 1000.0), "b": (None, None), "c": (None, None)}


def test_interaction_needs_both(spark):
    rows = readings_with_climate(*tables_of(spark, [(0, "a", 1.0)], [(0, "Norte", 20.0, None)])).collect()
    assert rows[0]["temp_humid_interaction"] is None and rows[0]["avg_temperature"] == 20.0


def test_two_climate_rows_make_two_feature_rows(spark):
    rows = feature_table(*tables_of(
        spark, [(0, "a", 1.0), (1, "a", 2.0)], [(0, "Norte", 20.0, 50.0), (0, "Norte", 21.0, 50.0)]
    )).orderBy("day_counter").collect()
    assert [r["day_counter"] for r in rows] == [1, 2, 3]
    assert [r["consumption_lag_1"] for r in rows] == [None, 1.0, 1.0]


def test_a_day_outside_the_calendar_still_counts_as_past(spark):
    given = tables_of(spark, [(0, "a", 1.0), (1, "a", 2.0), (2, "a", 4.0)], [(0, "Norte", 1.0, 1.0), (2, "Norte", 1.0, 1.0)])
    rows = global_table(feature_table(*given), calendar_table(distinct_days(given[2]))).orderBy("date").collect()
    assert [(r["date"], r["day_counter"], r["consumption_lag_1"]) for r in rows] == [(at(0), 1, None), (at(2), 3, 2.0)]
    assert (rows[0]["day_of_week_name"], rows[0]["month"], rows[0]["tipo_feriado"]) == (1, 1, "Nenhum")


def test_fill_follows_the_types(spark):
    df = spark.createDataFrame([(None, None, None, None)], "n int, x double, s string, d date")
    assert tuple(views.fill_numeric(df).first()) == (0, 0.0, None, None)
    assert tuple(views.fill_numeric(df, keep=["n"]).first()) == (None, 0.0, None, None)


def test_roles_of_a_short_and_a_long_series(spark):
    rows = [("long", at(d), 1.0, 2.0) for d in range(60)] + [("short", at(d), 1.0, 2.0) for d in range(5)]
    df = spark.createDataFrame(rows, "client_id string, date date, total_consumption double, prediction double")
    counts = {(r["client_id"], r["role"]): r["count"] for r in views.role_series(df, "10 days").groupBy("client_id", "role").count().collect()}
    assert counts == {
        ("long", "history"): 49, ("long", "test"): 11, ("long", "prediction"): 11,
        ("short", "history"): 5, ("short", "test"): 5, ("short", "prediction"): 5,
    }


def test_long_form_keeps_missing_predictions(spark):
    df = spark.createDataFrame([("a", START, 1.0, None)], "client_id string, date date, total_consumption double, prediction double")
    assert {(r["variable"], r["value"]) for r in views.long_form(df).collect()} == {("total_consumption", 1.0), ("prediction", None)}


def test_client_filter_reaches_the_scan(spark):
    from compare import SF_DIR
    from daypanel.sources.panels import long_readings

    df = views.client_series(long_readings(spark, SF_DIR), 7)
    assert "EqualTo(l_suppkey,7)" in df._jdf.queryExecution().executedPlan().toString()


def test_required_columns_and_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    with pytest.raises(ValueError, match="c"):
        views.require_columns(df, ["a", "c"])
    assert [tuple(r) for r in views.duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]


def test_a_view_is_replaced(spark):
    replace_view(spark.range(3), "something")
    replace_view(spark.range(5), "something")
    assert spark.table("something").count() == 5
