"""Complete jobs: build the feature tables, train with walk-forward validation, score, evaluate."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.functions.calendar import BRAZIL_HOLIDAYS_2023
from daypanel.operators.blocks import MAX_SERIES_ROWS, long_series
from daypanel.operators.calendar_table import calendar_table, distinct_days
from daypanel.operators.folds import Fold, FoldPlan, WindowSizeError, fold_plan_of, usable_folds
from daypanel.operators.gaps import impute_climate
from daypanel.operators.naive import days_too_long, pooled_scale, pooled_scale_by_fold, pooled_steps
from daypanel.operators.scores import METRICS, client_errors, evaluation_row, fold_errors
from daypanel.operators.views import fill_numeric, role_series
from daypanel.plans import runlog
from daypanel.plans.features import feature_table, global_table
from daypanel.plans.forecaster import CLIENT, PREDICTION, TARGET, Forecaster, Settings, fit, fit_plan, with_targets
from daypanel.sources.quarantine import read_csv_checked
from daypanel.sources.scratch import materialised
from daypanel.sources.tables import (
    CLIENT_SCHEMA, CLIMATE_SCHEMA, READING_SCHEMA, read_csv, read_panel, read_split, write_panel, write_splits,
)

EXPERIMENT = "panel_forecast"
TRAIN_RUN = "walk_forward"
INGEST_RUN, SCORE_RUN, EVALUATION_RUN = "ingest", "score", "evaluation"


@dataclass(frozen=True)
class WindowSizes:
    """Lengths of the first train window, each validation window and the test part."""

    initial_train: str = "2 months"
    validation: str = "1 month"
    test: str = "1 month"


@dataclass(frozen=True)
class Training:
    """What a training run leaves behind."""

    run_id: str
    plan: FoldPlan
    model: Forecaster
    fold_metrics: dict[int, dict[str, float]]
    average_metrics: dict[str, float]


def read_inputs(
    spark: SparkSession,
    clients: str,
    climate: str,
    readings: str,
    quarantine: str | None = None,
    max_bad_share: float | None = 0.01,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three raw CSV tables with their schemas.

    A row that doesn't fit is an error. With ``quarantine`` it is listed below that folder instead, and only a
    table with a larger share of such rows than ``max_bad_share`` is an error.
    """
    sources = {"clients": (clients, CLIENT_SCHEMA), "climate": (climate, CLIMATE_SCHEMA), "readings": (readings, READING_SCHEMA)}
    if quarantine is None:
        return tuple(read_csv(spark, path, schema) for path, schema in sources.values())
    return tuple(
        read_csv_checked(spark, path, schema, f"{quarantine}/{name}", max_bad_share)
        for name, (path, schema) in sources.items()
    )


def build_features(
    clients: DataFrame,
    climate: DataFrame,
    readings: DataFrame,
    out: str,
    holidays: DataFrame | Iterable[str] = BRAZIL_HOLIDAYS_2023,
    max_series_rows: int | None = MAX_SERIES_ROWS,
    experiment: str = EXPERIMENT,
) -> DataFrame:
    """Write treated climate, calendar, features and the global table; returns the last. Recorded in the log.

    Small tables are written first, so that the plan of the large ones knows their size.
    ``max_series_rows=None`` states that every series has at most one row per day and saves the
    count that looks for longer ones.
    """
    spark = readings.sparkSession
    with runlog.recorded(spark, f"{out}/log", runlog.Run(experiment, INGEST_RUN)):
        return _build_features(spark, clients, climate, readings, out, holidays, max_series_rows)


def _build_features(spark, clients, climate, readings, out, holidays, max_series_rows) -> DataFrame:
    limit = {} if max_series_rows is None else {"max_series_rows": max_series_rows}

    def long_keys(df: DataFrame, key: str) -> DataFrame | None:
        return None if max_series_rows is None else long_series(df, key, max_series_rows)

    def write_climate() -> DataFrame:
        treated = impute_climate(climate, long_keys=long_keys(climate, "region"), **limit)
        treated.write.mode("overwrite").parquet(f"{out}/climate")
        return spark.read.schema(treated.schema).parquet(f"{out}/climate")

    def write_calendar(treated: DataFrame) -> DataFrame:
        calendar = calendar_table(distinct_days(treated), holidays)
        calendar.coalesce(1).sortWithinPartitions("date").write.mode("overwrite").parquet(f"{out}/calendar")
        return spark.read.schema(calendar.schema).parquet(f"{out}/calendar")

    with ThreadPoolExecutor(2) as pool:  # steps that do not wait for each other
        long_clients = pool.submit(long_keys, readings, CLIENT)
        treated = write_climate()
        calendar = pool.submit(write_calendar, treated)
        write_panel(feature_table(readings, clients, treated, long_clients.result(), **limit), f"{out}/features")
        table = global_table(read_panel(spark, f"{out}/features"), calendar.result())
    write_panel(table, f"{out}/global", by_month=True)
    return read_panel(spark, f"{out}/global")


def train(
    spark: SparkSession,
    out: str,
    sizes: WindowSizes = WindowSizes(),
    settings: Settings = Settings(),
    parallel_folds: int = 2,
    experiment: str = EXPERIMENT,
) -> Training:
    """Walk-forward training on the global table below ``out``, recorded in the run log.

    The model of the last fold is the result, or with ``refit_on_all`` one more model that is
    fitted on every row before the test part, as long as the last fold's was. A failed run is
    recorded as failed with its reason, and the error is raised.
    """
    parent = runlog.Run(experiment, TRAIN_RUN)
    parent.note(
        walk_forward_initial_train_size=sizes.initial_train,
        walk_forward_validation_size=sizes.validation,
        test_size=sizes.test,
        exog_cols=list(settings.features),
    )
    folds: dict[int, runlog.Run] = {}
    try:
        result = _train(spark, out, sizes, settings, parallel_folds, parent, folds)
    except Exception as error:
        parent.note(status=error.reason if isinstance(error, WindowSizeError) else f"failed: {error}")
        parent.close(runlog.FAILED)
        for run in folds.values():
            if run.status != runlog.FINISHED:
                run.close(runlog.FAILED)
        runlog.append(spark, f"{out}/log", [parent, *folds.values()])
        raise
    parent.close(runlog.FINISHED)
    runlog.append(spark, f"{out}/log", [parent, *folds.values()])
    return result


def _train(spark, out, sizes, settings, parallel_folds, parent, runs) -> Training:
    panel = with_targets(read_panel(spark, f"{out}/global"), settings)
    plan, bounds = usable_folds(panel, fold_plan_of(panel, sizes.initial_train, sizes.validation, sizes.test))

    for fold in plan.folds:
        run = runs[fold.fold] = runlog.Run(parent.experiment, f"Fold_{fold.fold}", parent.run_id)
        trained, held = bounds[fold.fold, "train"], bounds[fold.fold, "validation"]
        run.note(
            random_state=settings.seed,
            categorical_feature=list(settings.categories),
            fold_train_start_date=trained["first_day"],
            fold_train_end_date=trained["last_day"],
            fold_val_start_date=held["first_day"],
            fold_val_end_date=held["last_day"],
        )
    models = fit_plan(read_panel(spark, f"{out}/global", before=plan.folds[-1].val_end), plan, settings)

    def stored_and_scored(fold: Fold, model: Forecaster) -> tuple[Forecaster, DataFrame]:
        run = runs[fold.fold]
        model.save(model_path(out, parent.run_id, run.name.lower()))
        run.close(runlog.FINISHED)
        validation = with_targets(read_panel(spark, f"{out}/global", fold.train_end, fold.val_end), settings)
        return model, model.score(validation).select(F.lit(fold.fold).alias("fold"), TARGET, PREDICTION)

    with ThreadPoolExecutor(parallel_folds) as pool:
        fitted = list(pool.map(stored_and_scored, plan.folds, models))

    model, kept = fitted[-1][0], f"fold_{plan.folds[-1].fold}"
    if settings.refit_on_all:
        rounds = replace(settings, rounds=model.trees.rounds)
        model, kept = fit(read_panel(spark, f"{out}/global", before=plan.test_start), None, rounds), "refit"
        model.save(model_path(out, parent.run_id, kept))
    parent.note(final_model=kept)

    targets = panel.select("date", CLIENT, TARGET)
    steps = pooled_steps(targets, long_days=days_too_long(targets))
    scored = reduce(DataFrame.unionByName, [predictions for _, predictions in fitted])
    table = fold_errors(scored, pooled_scale_by_fold(steps, plan)).collect()
    fold_metrics = {row["fold"]: {name: row[name] for name in METRICS} for row in table}
    averages = {f"avg_{name}": _mean(measured[name] for measured in fold_metrics.values()) for name in METRICS}
    for number, measured in fold_metrics.items():
        runs[number].measure(measured)
    parent.measure(averages)

    last = plan.folds[-1]
    for name, split in (("train", "train"), ("val", "validation")):
        row = bounds[last.fold, split]
        parent.note(**{f"final_{name}_start_date": row["first_day"], f"final_{name}_end_date": row["last_day"]})
    parts = {
        "train": read_panel(spark, f"{out}/global", before=last.train_end),
        "validation": read_panel(spark, f"{out}/global", last.train_end, last.val_end),
        "test": read_panel(spark, f"{out}/global", since=plan.test_start),
    }
    write_splits({name: fill_numeric(with_targets(part, settings), keep=[CLIENT]) for name, part in parts.items()}, splits_path(out, parent.run_id))
    return Training(parent.run_id, plan, model, fold_metrics, averages)


def _mean(values: Iterable[float | None]) -> float | None:
    known = [value for value in values if value is not None]
    return sum(known) / len(known) if known else None


def model_path(out: str, run_id: str, name: str) -> str:
    return f"{out}/models/{run_id}/{name}"


def splits_path(out: str, run_id: str) -> str:
    return f"{out}/splits/{run_id}"


@dataclass(frozen=True)
class Stored:
    """A training run found in the log."""

    run_id: str
    fold: int
    features: list[str]
    categories: list[str]
    model: Forecaster


def load_latest(spark: SparkSession, out: str, experiment: str = EXPERIMENT, name: str = TRAIN_RUN) -> Stored | None:
    """The newest finished training run with its newest fold's model, or None."""
    log = runlog.runs(spark, f"{out}/log").where(F.col("status") == runlog.FINISHED)
    parent = runlog.latest_named(log, experiment, name).first()
    if parent is None:
        return None
    folds = log.where(F.col("parent_run_id") == parent["run_id"]).withColumn("fold", runlog.fold_number("name"))
    child = runlog.latest(folds, F.col("fold").desc(), F.col("start_ts").desc()).first()
    if child is None:
        return None
    noted = {
        (row["run_id"], row["key"]): row
        for row in runlog.params(spark, f"{out}/log")
        .where(F.col("run_id").isin(parent["run_id"], child["run_id"]))
        .where(F.col("key").isin("exog_cols", "categorical_feature", "final_model"))
        .withColumn("names", F.when(F.col("key") != "final_model", runlog.text_list("value")))
        .collect()
    }
    kept = noted[parent["run_id"], "final_model"]["value"]
    return Stored(
        parent["run_id"],
        child["fold"],
        noted[parent["run_id"], "exog_cols"]["names"],
        noted[child["run_id"], "categorical_feature"]["names"],
        Forecaster.load(spark, model_path(out, parent["run_id"], kept)),
    )


def score(spark: SparkSession, out: str, experiment: str = EXPERIMENT) -> DataFrame:
    """Score the stored test part with the latest model, write it and return it; recorded in the log."""
    with runlog.recorded(spark, f"{out}/log", runlog.Run(experiment, SCORE_RUN)) as run:
        stored = load_latest(spark, out, experiment)
        if stored is None:
            raise LookupError(f"no finished training run in {experiment!r}")
        run.note(model_run_id=stored.run_id, fold=stored.fold)
        test = read_split(spark, splits_path(out, stored.run_id), "test")
        path = f"{out}/predictions/{stored.run_id}"
        write_panel(stored.model.score(test), path)
    return read_panel(spark, path)


def evaluate(
    spark: SparkSession, out: str, run_id: str, model: str = "GBT Global", experiment: str = EXPERIMENT
) -> tuple[DataFrame, DataFrame]:
    """The evaluation row of a run's scored test part, which is recorded in the log, and the errors of every client."""
    with runlog.recorded(spark, f"{out}/log", runlog.Run(experiment, EVALUATION_RUN)) as run:
        run.note(model_run_id=run_id, model=model)
        scored = read_panel(spark, f"{out}/predictions/{run_id}")
        trained = read_split(spark, splits_path(out, run_id), "train")
        steps = pooled_steps(trained, long_days=days_too_long(trained))
        overall = materialised(evaluation_row(scored, pooled_scale(steps), model), "evaluation")
        run.measure({name: overall.first()[name] for name in METRICS})
    return overall, client_errors(scored, scored)


def series_of(spark: SparkSession, out: str, model: Forecaster, client, test_size: str) -> DataFrame:
    """One client's history, test and prediction rows from the whole panel."""
    rows = read_panel(spark, f"{out}/global").where(F.col(CLIENT) == F.lit(client)).na.fill(0, subset=[TARGET])
    return role_series(model.score(rows), test_size)
