"""What may not depend on size, bad input or an empty log."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from daypanel.operators.scores import series_mase
from daypanel.plans import jobs, runlog
from daypanel.plans.forecaster import Settings, fit, vectors_for
from daypanel.sources import tables

SMALL = Settings(features=("client_id", "x"), categories=("client_id",), rounds=3, max_depth=2, patience=None)


def panel(spark, clients):
    rows = spark.range(2 * clients)
    client = F.concat(F.lit("c"), F.col("id") % clients)
    return rows.select(client.alias("client_id"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("total_consumption"))


def test_client_means_of_vectors_are_a_table_at_every_number(spark):
    kinds = [[type(s).__name__ for s in vectors_for(panel(spark, n), SMALL).preparation.stages] for n in (199, 1000)]
    assert kinds[0] == kinds[1]
    assert vectors_for(panel(spark, 201), SMALL).client_means is not None


def test_rounds_of_a_fit_are_a_prefix_of_a_longer_one(spark):
    rows = panel(spark, 20)
    long, short = (fit(rows, None, replace(SMALL, rounds=n)).trees for n in (4, 2))
    assert len(long.trees) == 4 and [t.splits for t in long.trees[:2]] == [t.splits for t in short.trees]


def test_a_malformed_row_is_an_error(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("date,client_id,consumption_kwh\n2024-13-45,a,12x\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_csv(spark, str(path), tables.READING_SCHEMA).collect()
    assert tables.read_csv(spark, str(path), tables.READING_SCHEMA, mode="PERMISSIVE").count() == 1


def test_no_run_yet(spark, tmp_path):
    assert runlog.runs(spark, str(tmp_path)).isEmpty()
    assert jobs.load_latest(spark, str(tmp_path)) is None


def test_a_client_without_training_rows_keeps_its_error(spark):
    scored = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 4.0)], "client_id string, total_consumption double, prediction double")
    scales = spark.createDataFrame([("a", 2.0)], "client_id string, scale double")
    found = {r.client_id: (r.mae, r.mase) for r in series_mase(scored, scales).collect()}
    assert found == {"a": (1.0, 0.5), "b": (3.0, None)}
