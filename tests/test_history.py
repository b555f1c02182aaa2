from datetime import date, timedelta
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from daypanel.operators.blocks import dense_index, in_blocks, long_series
from daypanel.operators.history import add_history
from daypanel.operators.naive import lag_forecast, series_scale

SCHEMA = "client_id string, date date, total_consumption double"
START = date(2024, 1, 1)


def panel(spark, **series):
    rows = [
        (client, START + timedelta(days=day), value) for client, points in series.items() for day, value in points
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_short_history(spark):
    rows = add_history(panel(spark, a=[(0, 4.0), (1, 6.0), (8, 9.0)])).orderBy("date").collect()
    assert [r["day_counter"] for r in rows] == [1, 2, 3]
    assert [r["consumption_lag_1"] for r in rows] == [None, 4.0, 6.0]
    assert [r["rolling_mean_3"] for r in rows] == [None, 4.0, 5.0]
    assert rows[0]["rolling_std_3"] is None and rows[1]["rolling_std_3"] is None
    assert rows[2]["rolling_std_3"] == pytest.approx(2 ** 0.5)
    assert [r["diff_lag_1"] for r in rows] == [None, 2.0, 3.0]


def test_constant_history_has_no_deviation(spark):
    rows = add_history(panel(spark, a=[(d, 5.0) for d in range(5)])).orderBy("date").collect()
    assert [round(r["rolling_std_3"], 9) for r in rows[2:]] == [0.0, 0.0, 0.0]


def test_only_the_difference_depends_on_the_row_itself(spark):
    given = panel(spark, a=[(d, float(d)) for d in range(20)])
    last = F.col("date") == F.lit(START + timedelta(days=19))
    changed = given.withColumn("total_consumption", F.when(last, 999.0).otherwise(F.col("total_consumption")))
    names = [c for c in add_history(given).columns if c not in ("total_consumption", "diff_lag_1")]
    before, after = (sorted(map(tuple, add_history(d).select(names).collect())) for d in (given, changed))
    assert before == after


@pytest.mark.parametrize("blocks_rows", [30, 100])
def test_long_series_in_blocks_equal_one_window(spark, blocks_rows):
    pick = random.Random(5)
    rows = []
    for client, length in (("hot", 500), ("warm", 130), ("cold", 12), ("single", 1)):
        for serial in range(length):
            value = None if pick.random() < 0.1 else round(pick.uniform(0, 50), 2)
            rows.append((client, START + timedelta(days=serial // 40), serial, value))
    df = spark.createDataFrame(rows, "client_id string, date date, serial int, total_consumption double").repartition(5)
    order = ["date", "serial"]
    keys = long_series(df, "client_id", blocks_rows)
    whole = add_history(df, order=order).toPandas()
    cut = add_history(df, order=order, long_keys=keys, max_series_rows=blocks_rows).toPandas()
    assert list(whole.columns) == list(cut.columns)
    left, right = (d.sort_values(["client_id", "serial"]).reset_index(drop=True) for d in (whole, cut))
    pd.testing.assert_frame_equal(left, right, rtol=1e-9, atol=1e-9)


def test_copies_of_one_row_are_cut_like_any_others(spark):
    rows = [("hot", START, 7.0)] * 400 + [("hot", START + timedelta(days=1), float(n)) for n in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    keys = long_series(df, "client_id", 50)
    blocks = in_blocks(df, ["client_id", "date", "total_consumption"], 8).groupBy("_block").count().collect()
    assert max(r["count"] for r in blocks) < 150
    order = ["date", "total_consumption"]
    done = add_history(df, order=order, long_keys=keys, max_series_rows=50).orderBy("day_counter").collect()
    assert [r["day_counter"] for r in done] == list(range(1, 431))
    values = [r["total_consumption"] for r in done]
    assert values == [7.0] * 400 + [float(n) for n in range(30)]
    assert [r["consumption_lag_15"] for r in done] == [None] * 15 + values[:-15]


def test_naive_forecast_of_long_series(spark):
    df = panel(spark, a=[(d, float(d * d)) for d in range(200)], b=[(0, 1.0), (1, 4.0)])
    keys = long_series(df, "client_id", 20)
    done = lag_forecast(df, long_keys=keys, max_series_rows=20).where("client_id = 'a'").orderBy("date").collect()
    assert [r["prediction"] for r in done] == [None] + [float(d * d) for d in range(199)]
    scales = {r["client_id"]: r["scale"] for r in series_scale(df, long_keys=keys, max_series_rows=20).collect()}
    assert scales == {"a": pytest.approx(199.0), "b": 3.0}


def test_no_long_series_means_no_second_path(spark):
    assert long_series(panel(spark, a=[(0, 1.0)]), "client_id", 10) is None


def test_blocks_follow_the_order(spark):
    df = spark.range(1000).repartition(7)
    ranges = in_blocks(df, ["id"], 6).groupBy("_block").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("_block").collect()
    assert len(ranges) > 3
    assert all(a["hi"] < b["lo"] for a, b in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("one_task_rows", [10, 100_000])
def test_dense_index(spark, one_task_rows):
    df = spark.range(500).selectExpr("CAST(id % 97 AS STRING) AS v").union(spark.sql("SELECT CAST(NULL AS STRING)"))
    indexed = {r["v"]: r["index"] for r in dense_index(df, "v", one_task_rows=one_task_rows).collect()}
    assert indexed == {v: i for i, v in enumerate(sorted(str(n) for n in range(97)))}
