"""Registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.functions.periods import parse_period, shift_column
from daypanel.operators import gaps, history, scores, views
from daypanel.operators.blocks import dense_index, long_series
from daypanel.operators.calendar_table import calendar_table, distinct_days
from daypanel.operators.folds import (
    FoldPlan, assign_folds, fold_bounds, fold_counts, fold_plan_of, holdout, plan_table,
)
from daypanel.operators.naive import lag_forecast, pooled_scale, pooled_scale_by_fold, pooled_steps, series_scale
from daypanel.plans import boosting, features, runlog
from daypanel.plans.forecaster import ALL_FEATURES, CATEGORIES, LEAK_FREE_FEATURES, Forecaster, Settings, fit, fit_plan, vectors_for
from daypanel.sources import panels, tables
from daypanel.sources.clustered import read_clustered, write_clustered
from daypanel.sources.quarantine import read_csv_checked
from daypanel.sources.scratch import materialised, new_path

Query = Callable[[SparkSession, str], DataFrame]

INITIAL, VALIDATION, TEST = "24 months", "6 months", "6 months"
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def six(column: str | Column) -> Column:
    return F.round(column, 6)


def out(df: DataFrame, *rounded: str) -> DataFrame:
    """Common output form: the day is called ``dt``, inexact numbers have six decimals."""
    df = df.withColumns({name: six(name) for name in rounded}) if rounded else df
    return df.withColumnRenamed("date", "dt")


# Shared inputs


def short_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of known clients with the target under its final name."""
    joined = features.readings_with_region(panels.readings(spark, sf_dir), panels.clients(spark, sf_dir))
    return joined.select("client_id", "date", F.col("consumption_kwh").alias("total_consumption"))


def climate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Treated climate as a table of its own: regions times days, of a size the planner can see."""
    return materialised(gaps.impute_climate(panels.climate(spark, sf_dir)), "climate")


def short_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_table(
        panels.readings(spark, sf_dir), panels.clients(spark, sf_dir), climate_table(spark, sf_dir)
    )


def climate_calendar(climate: DataFrame) -> DataFrame:
    days = distinct_days(climate)
    return calendar_table(days, panels.holidays_of(days))


def long_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = panels.long_days(spark, sf_dir)
    return calendar_table(days, panels.holidays_of(days))


def long_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.long_readings(spark, sf_dir).withColumnRenamed("consumption_kwh", "total_consumption")


def naive_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag_forecast(long_panel(spark, sf_dir))


def known(df: DataFrame) -> DataFrame:
    return df.where(F.col("prediction").isNotNull())


def raw_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of the long panel, before any aggregation: enough for its first and last day."""
    return panels.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))


def long_plan(spark: SparkSession, sf_dir: str) -> FoldPlan:
    return fold_plan_of(raw_days(spark, sf_dir), INITIAL, VALIDATION, TEST)


# Sources and sinks


@register
def csv_scan(spark, sf_dir):
    path = new_path(spark, "readings-csv")
    tables.write_csv(panels.readings(spark, sf_dir), path)
    schema = "client_id bigint, date date, consumption_kwh double"
    return out(tables.read_csv(spark, path, spark.createDataFrame([], schema).schema))


@register
def csv_quarantine(spark, sf_dir):
    """Readings of which a tenth of the clients report no number: good rows, and bad ones with their reason."""
    path, listed = new_path(spark, "spoilt-csv"), new_path(spark, "bad-rows")
    spoilt = F.when(F.col("client_id") % 10 == 3, "n/a").otherwise(F.col("consumption_kwh").cast("string"))
    tables.write_csv(panels.readings(spark, sf_dir).withColumn("consumption_kwh", spoilt), path)
    schema = spark.createDataFrame([], "client_id bigint, date date, consumption_kwh double").schema
    good = read_csv_checked(spark, path, schema, listed, max_bad_share=None)
    cells = F.split("text", ",")
    bad = spark.read.parquet(listed).select(
        cells[0].cast("bigint").alias("client_id"), cells[1].cast("date").alias("date"),
        cells[2].try_cast("double").alias("consumption_kwh"), "reason",
    )
    return out(good.unionByName(bad, allowMissingColumns=True))


@register
def parquet_sink_roundtrip(spark, sf_dir):
    path = new_path(spark, "readings-parquet")
    tables.write_panel(panels.readings(spark, sf_dir), path)
    return out(tables.read_panel(spark, path))


def split_roundtrip(spark, sf_dir, fmt: str) -> DataFrame:
    path = new_path(spark, "splits")
    plan = long_plan(spark, sf_dir)
    last, day, rows = plan.folds[-1], F.col("date"), long_panel(spark, sf_dir)
    tables.write_splits({
        "train": rows.where(day < F.lit(last.train_end)),
        "validation": rows.where((day >= F.lit(last.train_end)) & (day < F.lit(last.val_end))),
        "test": rows.where(day >= F.lit(plan.test_start)),
    }, path, fmt)
    parts = [
        tables.read_split(spark, path, name, rows.schema, fmt).withColumn("split", F.lit(name))
        for name in ("train", "validation", "test")
    ]
    return out(reduce(DataFrame.unionByName, parts))


@register
def split_sink_roundtrip(spark, sf_dir):
    return split_roundtrip(spark, sf_dir, "parquet")


@register
def split_csv_roundtrip(spark, sf_dir):
    return split_roundtrip(spark, sf_dir, "csv")


# Joins and projections


@register
def readings_with_region(spark, sf_dir):
    return out(features.readings_with_region(panels.readings(spark, sf_dir), panels.clients(spark, sf_dir)))


@register
def readings_with_climate(spark, sf_dir):
    rows = features.readings_with_climate(
        panels.readings(spark, sf_dir), panels.clients(spark, sf_dir), climate_table(spark, sf_dir)
    )
    return out(
        rows.select("date", "client_id", "total_consumption", "avg_temperature", "avg_humidity"), "avg_temperature"
    )


@register
def interaction_feature(spark, sf_dir):
    rows = features.readings_with_climate(
        panels.readings(spark, sf_dir), panels.clients(spark, sf_dir), climate_table(spark, sf_dir)
    )
    return out(rows.select("date", "client_id", "temp_humid_interaction"), "temp_humid_interaction")


# History features


def history_of(spark, sf_dir, *names: str) -> DataFrame:
    return history.add_history(short_panel(spark, sf_dir)).select("date", "client_id", *names)


@register
def day_counter(spark, sf_dir):
    return out(history_of(spark, sf_dir, "day_counter"))


@register
def lag_features(spark, sf_dir):
    lags = [f"consumption_lag_{k}" for k in history.LAGS]
    return out(history_of(spark, sf_dir, "total_consumption", "day_counter", *lags))


@register
def rolling_mean(spark, sf_dir):
    return out(history_of(spark, sf_dir, "rolling_mean_3", "rolling_mean_7"), "rolling_mean_3", "rolling_mean_7")


@register
def rolling_std(spark, sf_dir):
    return out(history_of(spark, sf_dir, "rolling_std_3", "rolling_std_7"), "rolling_std_3", "rolling_std_7")


@register
def diff_feature(spark, sf_dir):
    return out(history_of(spark, sf_dir, "diff_lag_1"), "diff_lag_1")


@register
def history_of_raw_lines(spark, sf_dir):
    """History over single lines, many per supplier and day, with long suppliers cut into blocks."""
    lines = panels.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("client_id"), "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_quantity").alias("total_consumption"),
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    features_of = history.add_history(lines, order=order, long_keys=long_series(lines, "client_id"))
    return out(
        features_of.select(
            "client_id", "l_orderkey", "l_linenumber", "l_partkey", "day_counter", "consumption_lag_1",
            "consumption_lag_15", "rolling_mean_7", "rolling_std_7",
        ),
        "rolling_mean_7", "rolling_std_7",
    )


FEATURE_ROUNDED = (
    "avg_temperature", "temp_humid_interaction", "rolling_mean_3", "rolling_std_3", "rolling_mean_7",
    "rolling_std_7", "diff_lag_1",
)


@register
def feature_table(spark, sf_dir):
    return out(short_features(spark, sf_dir), *FEATURE_ROUNDED)


def short_global(spark, sf_dir) -> DataFrame:
    climate = climate_table(spark, sf_dir)
    rows = features.feature_table(panels.readings(spark, sf_dir), panels.clients(spark, sf_dir), climate)
    return features.global_table(rows, climate_calendar(climate))


@register
def global_table(spark, sf_dir):
    return out(short_global(spark, sf_dir), *FEATURE_ROUNDED)


@register
def global_table_long(spark, sf_dir):
    """The global table over seven years, with every season and holiday."""
    climate = materialised(gaps.impute_climate(panels.long_climate(spark, sf_dir)), "climate")
    rows = features.feature_table(panels.long_readings(spark, sf_dir), panels.long_clients(spark, sf_dir), climate)
    return out(features.global_table(rows, climate_calendar(climate)), *FEATURE_ROUNDED)


@register
def feature_table_stored_panel(spark, sf_dir):
    """The features of seven years over readings that are stored by client, which need no shuffle any more."""
    path = new_path(spark, "readings-by-client")
    write_clustered(panels.long_readings(spark, sf_dir), path)
    climate = materialised(gaps.impute_climate(panels.long_climate(spark, sf_dir)), "climate")
    rows = features.feature_table(read_clustered(spark, path), panels.long_clients(spark, sf_dir), climate)
    return out(rows, *FEATURE_ROUNDED)


@register
def null_fill(spark, sf_dir):
    return out(views.fill_numeric(short_global(spark, sf_dir)), *FEATURE_ROUNDED)


@register
def key_uniqueness(spark, sf_dir):
    """Customers and days with several orders: rows that would share a place in a series."""
    orders = panels.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("client_id"), F.col("o_orderdate").cast("date").alias("date")
    )
    return out(views.duplicate_keys(orders, ["client_id", "date"]))


# Gap filling


def filled(spark, sf_dir, **columns: Column) -> DataFrame:
    rows = gaps.fill_gaps(panels.climate(spark, sf_dir), columns)
    return out(rows.select("region", "date", *columns), *columns)


@register
def interpolate_linear(spark, sf_dir):
    return filled(spark, sf_dir, temperature_linear=gaps.linear("temperature"))


@register
def forward_fill(spark, sf_dir):
    return filled(spark, sf_dir, temperature_ffill=gaps.forward("temperature"))


@register
def backward_fill(spark, sf_dir):
    return filled(spark, sf_dir, temperature_bfill=gaps.backward("temperature"))


@register
def impute_climate(spark, sf_dir):
    return out(gaps.impute_climate(panels.climate(spark, sf_dir)), "temperature")


@register
def impute_climate_long(spark, sf_dir):
    return out(gaps.impute_climate(panels.long_climate(spark, sf_dir)), "temperature")


# Calendar


def calendar_of(spark, sf_dir, *names: str) -> DataFrame:
    return out(long_calendar(spark, sf_dir).select("date", *names))


@register
def distinct_dates(spark, sf_dir):
    return out(distinct_days(panels.climate(spark, sf_dir)))


@register
def calendar_parts(spark, sf_dir):
    return calendar_of(spark, sf_dir, "month", "week_of_year", "day_of_week", "day_of_year")


@register
def calendar_flags(spark, sf_dir):
    return calendar_of(spark, sf_dir, "is_final_semana", "is_dia_util")


@register
def calendar_season(spark, sf_dir):
    return calendar_of(spark, sf_dir, "estacao")


@register
def calendar_holiday(spark, sf_dir):
    return calendar_of(spark, sf_dir, "is_feriado", "is_feriado_prolongado", "tipo_feriado")


@register
def calendar_holiday_long_first(spark, sf_dir):
    """The variant in which the long-holiday label wins."""
    days = panels.long_days(spark, sf_dir)
    return out(calendar_table(days, panels.holidays_of(days), long_first=True).select("date", "tipo_feriado"))


@register
def calendar_table_full(spark, sf_dir):
    return out(long_calendar(spark, sf_dir))


QUERIES["calendar_table"] = QUERIES.pop("calendar_table_full")


@register
def period_shift(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    moves = {
        "plus_1_month": "1 month", "minus_1_month": "-1 month", "plus_2_years": "2 years", "plus_30_days": "30 days",
        "minus_2_weeks": "-2 weeks", "plus_12_hours": "12 hours",
    }
    return (
        panels.table(spark, sf_dir, "orders")
        .select(day.alias("dt"))
        .distinct()
        .withColumns({name: shift_column(F.col("dt"), parse_period(text)) for name, text in moves.items()})
        .withColumn("plus_12_hours", F.date_format("plus_12_hours", "yyyy-MM-dd HH:mm:ss"))
    )


# Windows of time


@register
def holdout_split(spark, sf_dir):
    plan = long_plan(spark, sf_dir)
    return out(holdout(long_panel(spark, sf_dir), plan.test_start))


@register
def fold_plan(spark, sf_dir):
    return plan_table(spark, long_plan(spark, sf_dir))


@register
def walk_forward_assign(spark, sf_dir):
    rows = long_panel(spark, sf_dir).select("client_id", "date")
    return out(assign_folds(rows, long_plan(spark, sf_dir)))


@register
def fold_bounds_query(spark, sf_dir):
    return fold_bounds(long_panel(spark, sf_dir), long_plan(spark, sf_dir))


QUERIES["fold_bounds"] = QUERIES.pop("fold_bounds_query")


@register
def fold_counts_query(spark, sf_dir):
    return fold_counts(long_panel(spark, sf_dir), long_plan(spark, sf_dir))


QUERIES["fold_counts"] = QUERIES.pop("fold_counts_query")


# Scores of the naive forecast


@register
def metrics_global(spark, sf_dir):
    return out(scores.error_table(known(naive_panel(spark, sf_dir))), "mae", "rmse", "r2", "mape")


@register
def client_metrics(spark, sf_dir):
    clients = panels.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("client_id"))
    return out(scores.client_errors(naive_panel(spark, sf_dir), clients), "mae", "rmse", "r2")


@register
def mase_pooled(spark, sf_dir):
    scales = pooled_scale_by_fold(pooled_steps(long_panel(spark, sf_dir)), long_plan(spark, sf_dir))
    return out(scales, "scale")


@register
def mase_pooled_with_gaps(spark, sf_dir):
    """Scales of a panel in which every seventh value or so is missing."""
    gone = (F.col("client_id") + F.dayofmonth("date")) % 7 == 0
    holed = long_panel(spark, sf_dir).withColumn("total_consumption", F.when(~gone, F.col("total_consumption")))
    return out(pooled_scale_by_fold(pooled_steps(holed), long_plan(spark, sf_dir)), "scale")


@register
def mase_by_series(spark, sf_dir):
    plan = long_plan(spark, sf_dir)
    day, start = F.col("date"), F.lit(plan.test_start)
    scales = series_scale(long_panel(spark, sf_dir).where(day < start))
    test = known(naive_panel(spark, sf_dir)).where(day >= start)
    return out(scores.series_mase(test, scales), "mae", "scale", "mase")


@register
def mean_client_std(spark, sf_dir):
    return out(scores.mean_client_deviation(long_panel(spark, sf_dir)), "y_true_std")


def naive_fold_scores(spark, sf_dir) -> DataFrame:
    steps = pooled_steps(long_panel(spark, sf_dir))
    return scores.validation_errors(known(naive_panel(spark, sf_dir)), steps, long_plan(spark, sf_dir))


@register
def fold_metrics_naive(spark, sf_dir):
    return out(naive_fold_scores(spark, sf_dir), *scores.METRICS)


@register
def fold_average_metrics(spark, sf_dir):
    averages = scores.fold_averages(naive_fold_scores(spark, sf_dir))
    return out(averages, *averages.columns)


@register
def test_evaluation(spark, sf_dir):
    plan = long_plan(spark, sf_dir)
    test = known(naive_panel(spark, sf_dir)).where(F.col("date") >= F.lit(plan.test_start))
    trained = long_panel(spark, sf_dir).where(F.col("date") < F.lit(plan.folds[-1].train_end))
    scale = pooled_scale(pooled_steps(trained))
    row = scores.evaluation_row(test, scale, "Naive lag 1")
    return out(row, *scores.METRICS, "y_true_std")


# Views


@register
def client_list(spark, sf_dir):
    return views.client_list(long_panel(spark, sf_dir))


@register
def client_series(spark, sf_dir):
    return out(views.client_series(long_panel(spark, sf_dir), 7))


@register
def series_long(spark, sf_dir):
    return out(views.long_form(naive_panel(spark, sf_dir).select(
        "client_id", "date", "total_consumption", "prediction"
    )))


@register
def client_role_series(spark, sf_dir):
    return out(views.role_series(naive_panel(spark, sf_dir), TEST))


@register
def category_index(spark, sf_dir):
    rows = materialised(short_global(spark, sf_dir).select(CATEGORIES), "categories")
    indexed = None
    for name in CATEGORIES:
        part = dense_index(rows, name).select(
            F.lit(name).alias("variable"), F.col(name).cast("string").alias("value"), F.col("index").alias("idx")
        )
        indexed = part if indexed is None else indexed.unionByName(part)
    return indexed


@register
def category_bins(spark, sf_dir):
    """The bins that the trees use for categories: most frequent labels first."""
    rows = materialised(short_global(spark, sf_dir).select(CATEGORIES), "categories")
    learned = boosting.learn_bins(rows, CATEGORIES, CATEGORIES)
    found = [(f.name, label, i + 1) for f in learned for i, label in enumerate(f.labels)]
    return spark.createDataFrame(found, "variable string, value string, bin bigint")


@register
def root_splits(spark, sf_dir):
    """The best split of each feature at the root of the first tree, its gain as a share of the target's variance."""
    rows = materialised(short_global(spark, sf_dir).select(*CATEGORIES, "day_counter", "total_consumption"), "split-rows")
    rows = rows.na.fill(0, subset=["total_consumption"])
    learned = boosting.learn_bins(rows, [*CATEGORIES, "day_counter"], CATEGORIES)
    squares = rows.agg(F.sum("total_consumption"), F.sum(F.col("total_consumption") ** 2), F.count("*")).first()
    spread = squares[1] - squares[0] ** 2 / squares[2]
    found = [
        (name, round(split.gain / spread, 6), split.left_rows, split.right_rows)
        for name, split in boosting.root_splits(rows, learned, "total_consumption") if split
    ]
    return spark.createDataFrame(found, "variable string, gain_share double, left_rows bigint, right_rows bigint")


# Run log


@register
def latest_run(spark, sf_dir):
    named = panels.run_log(spark, sf_dir).where(F.col("name") == "5-LOW")
    return runlog.latest(named, F.col("start_dt").desc(), F.col("seq").desc()).select("run_id", "name", "start_dt", "seq")


@register
def run_children(spark, sf_dir):
    return runlog.children(panels.run_log(spark, sf_dir)).select(
        "run_id", "parent_run_id", "parent_name", "name", "fold", "start_dt"
    )


@register
def newest_child_run(spark, sf_dir):
    return runlog.newest_children(panels.run_log(spark, sf_dir), "start_dt", "run_id")


@register
def run_feature_list(spark, sf_dir):
    """Lists that every order run would store as text, parsed back into names."""
    stored = F.concat(F.lit("['"), F.col("o_orderpriority"), F.lit("', '"), F.col("o_orderstatus"), F.lit("']"))
    names = panels.table(spark, sf_dir, "orders").select("o_orderkey", runlog.text_list_of(stored).alias("names"))
    return names.select(
        "o_orderkey", F.col("names")[0].alias("first_name"), F.col("names")[1].alias("second_name"),
        F.size("names").cast("bigint").alias("listed"),
    )


@register
def run_log(spark, sf_dir):
    """Fold scores of the naive forecast, recorded as runs and read back from the log."""
    path = new_path(spark, "run-log")
    parent = runlog.Run("naive", "walk_forward")
    parent.note(walk_forward_initial_train_size=INITIAL, walk_forward_validation_size=VALIDATION, test_size=TEST)
    parent.close(runlog.FINISHED)
    recorded = [parent]
    for row in fold_metrics_naive(spark, sf_dir).collect():
        run = runlog.Run("naive", f"Fold_{row['fold']}", parent.run_id)
        run.measure({name: row[name] for name in scores.METRICS})
        run.close(runlog.FINISHED)
        recorded.append(run)
    runlog.append(spark, path, recorded)
    log = runlog.runs(spark, path)
    found = runlog.latest_named(log, "naive", "walk_forward").select(F.col("run_id").alias("parent_run_id"))
    folds = log.select("run_id", "parent_run_id", "name", "status").join(found, "parent_run_id")
    return folds.join(runlog.metrics(spark, path), "run_id").select(
        runlog.fold_number("name").cast("bigint").alias("fold"), "status", "key", "value"
    )


# Model


_MODELS: dict[tuple[str, str], tuple[Forecaster, DataFrame]] = {}


def model_panel(spark, sf_dir) -> DataFrame:
    """The global table of the long panel, with climate, as a table, since a fit reads it often."""
    climate = materialised(gaps.impute_climate(panels.long_climate(spark, sf_dir)), "climate")
    rows = features.feature_table(panels.long_readings(spark, sf_dir), panels.long_clients(spark, sf_dir), climate)
    return materialised(features.global_table(rows, climate_calendar(climate)).drop("diff_lag_1"), "model-panel")


def last_fold_model(spark, sf_dir) -> tuple[Forecaster, DataFrame]:
    """The model of the last fold and the test part; the queries of a session share one fit."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        plan, rows, day = long_plan(spark, sf_dir), model_panel(spark, sf_dir), F.col("date")
        last = plan.folds[-1]
        held = rows.where((day >= F.lit(last.train_end)) & (day < F.lit(last.val_end)))
        model = fit(rows.where(day < F.lit(last.train_end)), held)
        _MODELS[key] = model, rows.where(day >= F.lit(plan.test_start))
    return _MODELS[key]


@register
def feature_vector(spark, sf_dir):
    """Every element of the assembled vectors, clients represented by their mean target."""
    rows = short_global(spark, sf_dir)
    prepared = vectors_for(rows, Settings(features=tuple(ALL_FEATURES)))
    elements = F.posexplode(vector_to_array("features")).alias("position", "value")
    return out(prepared.of(rows).select("client_id", "date", elements), "value").withColumn(
        "position", F.col("position").cast("bigint")
    )


def scored() -> Column:
    """Whether a prediction is a finite number of a sensible size."""
    return F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < 1e9)


@register
def gbt_forecast(spark, sf_dir):
    """Errors on the test part of a model fitted on the last fold's train rows."""
    model, test = last_fold_model(spark, sf_dir)
    return scores.error_table(model.score(test))


@register
def batch_score(spark, sf_dir):
    """Scores of the test part, computed without the target column."""
    model, test = last_fold_model(spark, sf_dir)
    return out(model.score(test.drop("total_consumption")).select("client_id", "date", scored().alias("scored")))


@register
def prediction_preview(spark, sf_dir):
    model, test = last_fold_model(spark, sf_dir)
    shown = views.preview(model.score(test))
    return out(shown.select("client_id", "date", "total_consumption", scored().alias("scored")))


@register
def batch_score_complete(spark, sf_dir):
    """Every row of the test part with its inputs unchanged and one finite score."""
    model, test = last_fold_model(spark, sf_dir)
    return out(model.score(test).select("client_id", "date", "total_consumption", scored().alias("scored")))


@register
def model_roundtrip(spark, sf_dir):
    """Whether a model that was saved and loaded scores every row as it did before."""
    model, test = last_fold_model(spark, sf_dir)
    path = new_path(spark, "model")
    model.save(path)
    again = Forecaster.load(spark, path)
    both = again.score(model.score(test).withColumnRenamed("prediction", "before"))
    return out(both.select("client_id", "date", F.col("before").eqNullSafe(F.col("prediction")).alias("same_score")))


@register
def fold_metrics_gbt(spark, sf_dir):
    """Five metrics of a model per fold."""
    plan, rows, day = long_plan(spark, sf_dir), model_panel(spark, sf_dir), F.col("date")
    parts = []
    for fold, model in zip(plan.folds, fit_plan(rows, plan)):
        held = rows.where((day >= F.lit(fold.train_end)) & (day < F.lit(fold.val_end)))
        parts.append(model.score(held).select(F.lit(fold.fold).cast("bigint").alias("fold"), "total_consumption", "prediction"))
    scored = reduce(DataFrame.unionByName, parts)
    return scores.fold_errors(scored, pooled_scale_by_fold(pooled_steps(rows), plan))
