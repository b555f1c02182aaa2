"""The jobs from CSV files to evaluated scores, on one small panel."""

from datetime import date, timedelta
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from daypanel.operators.folds import WindowSizeError
from daypanel.plans import boosting, jobs, runlog
from daypanel.plans.features import FEATURE_COLUMNS, GLOBAL_COLUMNS
from daypanel.plans.forecaster import ALL_FEATURES, LEAK_FREE_FEATURES, Forecaster, Settings, fit
from daypanel.sources import tables

FIRST, DAYS = date(2023, 1, 1), 181
SIZES = jobs.WindowSizes()
QUICK = Settings(rounds=4, max_depth=3)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Six clients in two regions, one region unknown to the climate table, one unknown client."""
    folder, pick = tmp_path_factory.mktemp("raw"), random.Random(1)
    clients = [(f"C{n:04d}", ("Norte", "Sul", "Desconhecida")[n % 3]) for n in range(6)]
    days = [FIRST + timedelta(days=n) for n in range(DAYS)]
    climate = [
        (d, region, "" if pick.random() < 0.2 else round(20 + 8 * math.sin(n / 20), 1), 60)
        for region in ("Norte", "Sul") for n, d in enumerate(days)
    ]
    readings = [
        (d, client, "" if pick.random() < 0.02 else round(10 + int(client[1:]) + 3 * math.sin(n / 7) + pick.random(), 2))
        for client, _ in [*clients, ("C9999", "")] for n, d in enumerate(days)
    ]
    for name, header, rows in (
        ("clients", "client_id,region", clients), ("climate", "date,region,temperature,humidity", climate),
        ("readings", "date,client_id,consumption_kwh", readings),
    ):
        lines = [header, *[",".join(str(v) for v in row) for row in rows]]
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return folder


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    inputs = jobs.read_inputs(spark, *[str(raw / f"{n}.csv") for n in ("clients", "climate", "readings")])
    return out, jobs.build_features(*inputs, out)


@pytest.fixture(scope="module")
def trained(spark, built):
    return jobs.train(spark, built[0], SIZES, QUICK)


def test_global_table(built):
    _, table = built
    assert table.columns == GLOBAL_COLUMNS
    assert table.count() == 6 * DAYS
    missing = table.where(F.col("avg_temperature").isNull()).select("client_id").distinct()
    assert {r["client_id"] for r in missing.collect()} == {"C0002", "C0005"}


def test_written_tables(spark, built):
    out, table = built
    assert tables.read_panel(spark, f"{out}/features").columns == FEATURE_COLUMNS
    assert spark.read.parquet(f"{out}/calendar").count() == DAYS
    since, before = date(2023, 2, 10), date(2023, 4, 3)
    part = tables.read_panel(spark, f"{out}/global", since, before)
    assert part.count() == 6 * (before - since).days
    plan = part._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert re.search(r"PartitionFilters: \[.*period.*2023-02.*2023-04", scan)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(date,2023-02-10\).*LessThan\(date,2023-04-03\)", scan)


def test_long_series_give_the_same_table(spark, raw, built, tmp_path):
    inputs = jobs.read_inputs(spark, *[str(raw / f"{n}.csv") for n in ("clients", "climate", "readings")])
    cut = jobs.build_features(*inputs, str(tmp_path), max_series_rows=60)
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in cut.dtypes]
    assert cut.select(rounded).exceptAll(built[1].select(rounded)).isEmpty()
    assert cut.count() == built[1].count()


def test_training_is_recorded(spark, built, trained):
    out = built[0]
    assert [f.fold for f in trained.plan.folds] == [1, 2]
    assert set(trained.fold_metrics) == {1, 2}
    for name, value in trained.average_metrics.items():
        plain = name.removeprefix("avg_")
        assert value == pytest.approx(sum(m[plain] for m in trained.fold_metrics.values()) / 2)
    log = runlog.runs(spark, f"{out}/log")
    assert log.where(F.col("status") == runlog.FINISHED).where(F.col("parent_run_id") == trained.run_id).count() == 2
    params = {r["key"]: r["value"] for r in runlog.params(spark, f"{out}/log").where(F.col("run_id") == trained.run_id).collect()}
    assert params["final_val_end_date"] == "2023-04-30" and params["final_train_end_date"] == "2023-03-31"


def test_latest_run_scores_the_test_part(spark, built, trained):
    out = built[0]
    stored = jobs.load_latest(spark, out)
    assert (stored.run_id, stored.fold) == (trained.run_id, 2)
    assert stored.features == LEAK_FREE_FEATURES
    scored = jobs.score(spark, out)
    assert scored.agg(F.min("date")).first()[0] == trained.plan.test_start
    assert scored.where(F.col("prediction").isNull()).isEmpty()
    row, per_client = jobs.evaluate(spark, out, trained.run_id)
    assert row.count() == 1 and row.first()["mae"] > 0 and row.first()["client_id"] == "Global"
    assert per_client.count() == 6
    view = jobs.series_of(spark, out, stored.model, "C0001", SIZES.test)
    assert {r["role"] for r in view.select("role").distinct().collect()} == {"history", "test", "prediction"}


def test_refit_on_everything_before_the_test_part(spark, built):
    out, settings = built[0], Settings(rounds=2, max_depth=2, refit_on_all=True)
    run = jobs.train(spark, out, SIZES, settings, experiment="refit")
    stored = jobs.load_latest(spark, out, "refit")
    assert stored.run_id == run.run_id
    rows = built[1].where(F.col("date") >= F.lit(run.plan.test_start)).orderBy("client_id", "date")
    kept, last_fold = stored.model, Forecaster.load(spark, jobs.model_path(out, run.run_id, "fold_2"))
    refit, loaded, other = ([r["prediction"] for r in m.score(rows).collect()] for m in (run.model, kept, last_fold))
    assert refit == loaded != other


def test_a_failed_run_is_recorded_as_failed(spark, built):
    out = built[0]
    with pytest.raises(WindowSizeError):
        jobs.train(spark, out, jobs.WindowSizes(initial_train="2 years"), QUICK, experiment="too long")
    row = runlog.runs(spark, f"{out}/log").where(F.col("experiment") == "too long").first()
    assert row["status"] == runlog.FAILED
    reasons = runlog.params(spark, f"{out}/log").where((F.col("run_id") == row["run_id"]) & (F.col("key") == "status"))
    assert reasons.first()["value"] == "initial_train_size"
    assert jobs.load_latest(spark, out, "too long") is None


def test_all_features_and_new_clients(spark, built, tmp_path):
    table = built[1]
    by_mean = fit(table, None, Settings(features=tuple(ALL_FEATURES), rounds=2, max_depth=2))
    by_mean.save(str(tmp_path))
    again = Forecaster.load(spark, str(tmp_path))
    newcomer = table.where(F.col("client_id") == "C0000").withColumn("client_id", F.lit("new"))
    rows = table.unionByName(newcomer).drop("total_consumption")
    keys = ["client_id", "date"]
    before, after = by_mean.score(rows).orderBy(keys).collect(), again.score(rows).orderBy(keys).collect()
    assert [r["prediction"] for r in before] == [r["prediction"] for r in after]
    assert len(before) == 7 * DAYS and all(r["prediction"] is not None for r in before)


def test_unseen_category_can_be_scored(built):
    model = fit(built[1], None, QUICK)
    odd = built[1].limit(3).withColumn("client_id", F.lit("new")).withColumn("tipo_feriado", F.lit("?"))
    assert all(r["prediction"] is not None for r in model.score(odd).collect())


def test_missing_input_column_is_named(built):
    with pytest.raises(ValueError, match="consumption_lag_7"):
        fit(built[1].drop("consumption_lag_7"))


@pytest.mark.parametrize("errors, patience, rounds, stops", [
    ([9, 5, 4, 3, 2], 10, 4, False),
    ([9, 5, 4, 4.5, 3, 6, 6, 6], 3, 4, True),
    ([9, 5, 4, 4.5, 4.6], 2, 2, True),
    ([9, 5, 6], 1, 1, True),
    ([1, 5], 3, 1, False),
])
def test_patience(errors, patience, rounds, stops):
    """Errors after 0, 1, ... rounds; the start value alone is no model."""
    assert (boosting.best_round(errors), boosting.stops(errors, patience)) == (rounds, stops)


def test_early_stop_shortens_the_fit(built):
    """Validation rows without any relation to the features: more trees only hurt, and are not fitted."""
    noise = built[1].withColumn("total_consumption", -F.col("total_consumption"))
    model = fit(built[1], noise, Settings(rounds=30, max_depth=2, patience=2))
    assert model.trees.rounds == 1 and len(model.trees.errors) - 1 <= 1 + 2


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "c.csv").write_text("region,client_id\nNorte,C1\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv(spark, str(tmp_path / "c.csv"), tables.CLIENT_SCHEMA).collect()


def test_nan_is_missing(spark, tmp_path):
    (tmp_path / "r.csv").write_text("date,client_id,consumption_kwh\n2023-01-01,a,NaN\n2023-01-02,a,1.5\n")
    rows = tables.read_csv(spark, str(tmp_path / "r.csv"), tables.READING_SCHEMA).orderBy("date").collect()
    assert [r["consumption_kwh"] for r in rows] == [None, 1.5]


def test_text_that_is_no_date_becomes_null(spark):
    df = spark.createDataFrame([("2023-01-31",), ("2023-02-30",), ("x",)], "d string")
    assert [r["d"] for r in df.select(tables.day("d").alias("d")).collect()] == [date(2023, 1, 31), None, None]


def test_csv_splits(spark, tmp_path):
    df = spark.createDataFrame([(1, date(2023, 1, 1), 2.5), (2, date(2023, 1, 2), None)], "client_id int, date date, y double")
    tables.write_splits({"train": df.limit(1), "test": df}, str(tmp_path / "s"), "csv")
    back = tables.read_split(spark, str(tmp_path / "s"), "test", df.schema, "csv")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_missing_targets_can_be_left_out(spark, built, tmp_path):
    """With the option on, every figure equals that of a panel without the rows."""
    gaps = F.col("total_consumption").isNotNull() & (F.dayofmonth("date") % 5 != 0)
    holed = built[1].withColumn("total_consumption", F.when(gaps, F.col("total_consumption")))
    settings, found = Settings(rounds=2, max_depth=2, drop_missing_target=True), []
    for name, table in (("holed", holed), ("dropped", holed.where("total_consumption IS NOT NULL"))):
        out = str(tmp_path / name)
        tables.write_panel(table, f"{out}/global", by_month=True)
        run = jobs.train(spark, out, SIZES, settings)
        scored = jobs.score(spark, out)
        row, _ = jobs.evaluate(spark, out, run.run_id)
        assert scored.where("total_consumption IS NULL").isEmpty()
        found.append((run.fold_metrics, row.first().asDict(), scored.count()))
    (folds, row, rows), (folds_dropped, row_dropped, rows_dropped) = found
    assert rows == rows_dropped
    for fold, metrics in folds.items():
        assert metrics == pytest.approx(folds_dropped[fold])
    assert {k: v for k, v in row.items() if isinstance(v, float)} == pytest.approx(
        {k: v for k, v in row_dropped.items() if isinstance(v, float)}
    )


def test_scores_leave_missing_targets_alone(built):
    model = fit(built[1], None, QUICK)
    unknown = built[1].limit(5).withColumn("total_consumption", F.lit(None).cast("double"))
    assert [(r["total_consumption"], r["prediction"] is None) for r in model.score(unknown).collect()] == [(None, False)] * 5


def test_every_job_is_recorded(spark, built, trained):
    out = built[0]
    jobs.score(spark, out)
    jobs.evaluate(spark, out, trained.run_id)
    with pytest.raises(LookupError):
        jobs.score(spark, out, "nothing trained")
    log = runlog.runs(spark, f"{out}/log")
    names = {(r["experiment"], r["name"], r["status"]) for r in log.collect()}
    done = {(jobs.EXPERIMENT, name, runlog.FINISHED) for name in ("ingest", "score", "evaluation", jobs.TRAIN_RUN)}
    assert done <= names and ("nothing trained", "score", runlog.FAILED) in names
    measured = runlog.metrics(spark, f"{out}/log").join(log.where("name = 'evaluation'").select("run_id"), "run_id")
    assert {"mae", "rmse", "mase"} <= {r["key"] for r in measured.collect()}


def test_finished_folds_of_a_failed_run_stay_finished(spark, built, monkeypatch):
    out = built[0]
    monkeypatch.setattr(jobs, "fold_errors", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.train(spark, out, SIZES, Settings(rounds=1, max_depth=1), experiment="late failure")
    log = runlog.runs(spark, f"{out}/log").where("experiment = 'late failure'")
    status = {(r["name"], r["status"]) for r in log.collect()}
    assert status == {(jobs.TRAIN_RUN, runlog.FAILED), ("Fold_1", runlog.FINISHED), ("Fold_2", runlog.FINISHED)}
