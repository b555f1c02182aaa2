"""The shape of the physical plans: how often rows move, and what is broadcast."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from compare import SF_DIR
from daypanel.operators.calendar_table import calendar_table, distinct_days
from daypanel.operators.folds import assign_folds, fold_bounds, fold_plan_of
from daypanel.operators.gaps import impute_climate
from daypanel.operators.scores import error_table
from daypanel.plans.features import feature_table, global_table
from daypanel.sources import panels
from daypanel.sources.scratch import materialised


def plan_of(df):
    """The plan before execution, each operator once."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def moves(df):
    return len(re.findall(r"(?<!Broadcast)Exchange ", plan_of(df)))


@pytest.fixture(scope="module")
def stored(spark):
    return {
        "readings": materialised(panels.long_readings(spark, SF_DIR), "readings"),
        "clients": materialised(panels.long_clients(spark, SF_DIR), "clients"),
        "climate": materialised(panels.long_climate(spark, SF_DIR), "climate"),
    }


def test_features_move_the_readings_once(stored):
    features = feature_table(stored["readings"], stored["clients"], stored["climate"])
    assert moves(features) == 1
    assert len(re.findall(r"\bSort \[", plan_of(features))) == 1
    table = global_table(features, calendar_table(distinct_days(stored["climate"])))
    assert moves(table) == 2  # the second one is the distinct days of the calendar
    assert "Python" not in plan_of(table) and "CartesianProduct" not in plan_of(table)


def test_a_large_climate_table_is_shuffled_and_not_broadcast(spark, stored):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "Broadcast" not in plan_of(feature_table(*stored.values()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_unused_columns_are_not_read(stored):
    lags = feature_table(*stored.values()).select("client_id", "date", "consumption_lag_7")
    assert not re.search(r"ReadSchema: struct<[^>]*(temperature|humidity)", plan_of(lags))


def test_gap_filling_moves_the_climate_once(stored):
    filled = impute_climate(stored["climate"])
    assert moves(filled) == 1
    assert len(re.findall(r"\bSort \[", plan_of(filled))) == 2  # one per direction
    assert "unboundedfollowing" not in plan_of(filled)


def test_folds_are_assigned_without_moving_rows(stored):
    plan = fold_plan_of(stored["readings"], "24 months", "6 months", "6 months")
    assigned = assign_folds(stored["readings"], plan)
    assert moves(assigned) == 0
    assert "BroadcastHashJoin" in plan_of(assigned) and "NestedLoop" not in plan_of(assigned)
    counted = plan_of(fold_bounds(stored["readings"], plan))
    assert counted.index("BroadcastHashJoin") < counted.rindex("partial_count(1)")  # days are counted below the join


def test_many_fold_days_are_not_broadcast(stored, monkeypatch):
    plan = fold_plan_of(stored["readings"], "24 months", "6 months", "6 months")
    monkeypatch.setattr("daypanel.operators.folds.MAX_BROADCAST_DAYS", 10)
    df = assign_folds(stored["readings"], plan)
    assert "strategy=broadcast" not in df._jdf.queryExecution().analyzed().toString()


def test_metrics_are_partial_sums(stored):
    scored = stored["readings"].select("client_id", F.col("consumption_kwh").alias("total_consumption"), F.lit(1.0).alias("prediction"))
    for by in ([], ["client_id"]):
        assert "partial_avg" in plan_of(error_table(scored, by))


def test_date_filters_reach_the_files(stored):
    cut = stored["readings"].where(F.col("date") >= F.lit(date(1999, 1, 1)))
    assert "GreaterThanOrEqual(date,1999-01-01)" in plan_of(cut)
