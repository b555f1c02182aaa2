"""Panels stored by series: same rows, no shuffle for windows and joins by series."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from daypanel.operators.history import add_history
from daypanel.sources.clustered import read_clustered, write_clustered

FIRST = date(2023, 1, 1)


@pytest.fixture(scope="module")
def panel(spark):
    """Series of uneven length; the first holds a third of all rows, one has no name, one day is missing."""
    rows = [(f"C{n:02d}", FIRST + timedelta(days=d), float((n * 31 + d * 7) % 101)) for n in range(20) for d in range(60)]
    rows += [("C00", FIRST + timedelta(days=d), float(d)) for d in range(60, 660)]
    rows += [(None, FIRST, 1.0), (None, FIRST, 1.0), ("C01", None, 2.0)]
    return spark.createDataFrame(rows, "client_id string, date date, total_consumption double")


@pytest.fixture(scope="module")
def stored(spark, panel, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "it's a panel")
    write_clustered(panel, path, buckets=6)
    return path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same_rows(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_rows_come_back_whole(spark, panel, stored):
    again = read_clustered(spark, stored)
    assert again.columns == panel.columns and same_rows(again, panel)


def test_history_needs_no_exchange(spark, panel, stored):
    whole = panel.where("client_id IS NOT NULL AND date IS NOT NULL")
    kept = read_clustered(spark, stored).where("client_id IS NOT NULL AND date IS NOT NULL")
    by_series = add_history(kept)
    assert "Exchange" not in plan_of(by_series) and "Exchange" in plan_of(add_history(whole))
    assert same_rows(by_series, add_history(whole))


def test_join_of_two_panels_needs_no_exchange(spark, panel, stored, tmp_path):
    other = panel.groupBy("client_id").agg(F.max("date").alias("date"), F.count("*").alias("days"))
    write_clustered(other, str(tmp_path), buckets=6)
    facts, ends = read_clustered(spark, stored), read_clustered(spark, str(tmp_path)).drop("date")
    joined = facts.hint("merge").join(ends, "client_id")
    assert "Exchange" not in plan_of(joined)
    assert same_rows(joined, panel.join(other.drop("date"), "client_id"))


def test_the_feature_table_moves_no_reading(spark, stored):
    from daypanel.plans.features import feature_table

    readings = read_clustered(spark, stored).withColumnRenamed("total_consumption", "consumption_kwh")
    clients = spark.createDataFrame([("C00", "Sul"), ("C01", "Norte")], "client_id string, region string")
    climate = spark.createDataFrame(
        [(FIRST, "Sul", 20.0, 60.0)], "date date, region string, temperature double, humidity double"
    )
    table = feature_table(readings, F.broadcast(clients), F.broadcast(climate))
    assert "hashpartitioning(client_id" not in plan_of(table)
    plain = spark.createDataFrame(readings.collect(), readings.schema)
    assert same_rows(table, feature_table(plain, clients, climate))


def test_days_are_pruned_by_month(spark, panel, stored):
    since, before = date(2023, 2, 10), date(2023, 4, 3)
    part = read_clustered(spark, stored, since, before)
    assert same_rows(part, panel.where((F.col("date") >= F.lit(since)) & (F.col("date") < F.lit(before))))
    assert "2023-02" in plan_of(part)[plan_of(part).index("PartitionFilters"):]


def test_another_session_finds_the_buckets(spark, panel, stored):
    from daypanel.sources.clustered import _table_name

    layout = spark.read.json(f"{stored}/layout").first()["id"]
    spark.sql(f"DROP TABLE {_table_name(stored, layout)}")
    again = read_clustered(spark, stored)
    assert same_rows(again, panel)
    assert "Exchange" not in plan_of(add_history(again))


def test_writing_again_replaces_rows_and_buckets(spark, panel, tmp_path):
    write_clustered(panel, str(tmp_path), buckets=3)
    assert read_clustered(spark, str(tmp_path)).count() == panel.count()
    shorter = panel.where("client_id = 'C05'").withColumn("extra", F.lit(1))
    write_clustered(shorter, str(tmp_path), buckets=2)
    assert same_rows(read_clustered(spark, str(tmp_path)), shorter)


def test_an_empty_panel(spark, panel, tmp_path):
    write_clustered(panel.limit(0), str(tmp_path), buckets=2)
    again = read_clustered(spark, str(tmp_path))
    assert again.columns == panel.columns and again.isEmpty()


def test_the_layouts_own_column_is_refused(spark, panel, tmp_path):
    with pytest.raises(ValueError, match="period"):
        write_clustered(panel.withColumn("period", F.lit("x")), str(tmp_path))
