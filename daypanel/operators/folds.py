"""Holdout and walk-forward windows: planning the bounds and assigning rows to them.

Bounds come from one min/max aggregate and are a handful of dates. Rows find their windows
through a table with one entry per calendar day and window, joined on the day: a plain hash
join instead of a comparison of every row with every window.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.functions.periods import Period, first_day_from, midnight, parse_period, shift

MAX_BROADCAST_DAYS = 1_000_000


class WindowSizeError(ValueError):
    """The window sizes do not fit the data; ``reason`` is a short code for the run log."""

    def __init__(self, reason: str, message: str):
        super().__init__(message)
        self.reason = reason


@dataclass(frozen=True)
class Fold:
    """Train on ``[train_start, train_end)``, validate on ``[train_end, val_end)``."""

    fold: int
    train_start: date
    train_end: date
    val_end: date


@dataclass(frozen=True)
class FoldPlan:
    first_day: date
    test_start: date
    last_day: date
    folds: tuple[Fold, ...]


def day_range(df: DataFrame, date: str = "date") -> tuple[date | None, date | None]:
    return tuple(df.agg(F.min(date), F.max(date)).first())


def holdout_start(last_day: date, test_size: str) -> date:
    """First day of the test part: the last day minus the test period, itself included."""
    return first_day_from(shift(midnight(last_day), -parse_period(test_size)))


def plan_folds(
    first_day: date | None,
    last_day: date | None,
    last_train_val_day: date | None,
    initial_train_size: str,
    validation_size: str,
    test_size: str,
) -> FoldPlan:
    """Expanding train windows, each followed by a validation window of fixed length.

    Every step is taken from the bound before it, so a month that was clipped to its last day
    stays clipped. ``last_train_val_day`` is the last day in the data before the test part.
    """
    if last_day is None or last_train_val_day is None or first_day is None:
        raise WindowSizeError("empty_train_val", f"no rows are left before a test part of {test_size!r}")
    initial, step = parse_period(initial_train_size), parse_period(validation_size)
    train_end, limit = shift(midnight(first_day), initial), midnight(last_train_val_day)
    if train_end >= limit:
        raise WindowSizeError(
            "initial_train_size", f"a first train window of {initial_train_size!r} leaves nothing to validate on"
        )
    if shift(train_end, step) > limit:
        raise WindowSizeError(
            "validation_size", f"the first validation window of {validation_size!r} runs past {last_train_val_day}"
        )
    return FoldPlan(
        first_day,
        holdout_start(last_day, test_size),
        last_day,
        tuple(_walk(first_day, train_end, step, limit)),
    )


def _walk(first_day: date, train_end: datetime, step: Period, limit: datetime):
    if shift(train_end, step) <= train_end:
        raise WindowSizeError("validation_size", "the validation period must move forward")
    number = 1
    while (val_end := shift(train_end, step)) <= limit:
        yield Fold(number, first_day, first_day_from(train_end), first_day_from(val_end))
        number, train_end = number + 1, val_end


def fold_plan_of(
    df: DataFrame, initial_train_size: str, validation_size: str, test_size: str, date: str = "date"
) -> FoldPlan:
    """Plan the windows of a panel; only min and max of the date column leave the cluster."""
    first_day, last_day = day_range(df, date)
    last_train_val = None
    if last_day is not None:
        before_test = df.where(F.col(date) < F.lit(holdout_start(last_day, test_size)))
        last_train_val = day_range(before_test, date)[1]
    return plan_folds(first_day, last_day, last_train_val, initial_train_size, validation_size, test_size)


def plan_table(spark: SparkSession, plan: FoldPlan) -> DataFrame:
    """The planned bounds as a table, one row per fold."""
    rows = [(f.fold, f.train_start, f.train_end, f.val_end) for f in plan.folds]
    return spark.createDataFrame(rows, "fold bigint, train_start date, train_end date, val_end date")


def holdout(df: DataFrame, test_start: date, date: str = "date") -> DataFrame:
    """Add ``split``: 'test' from the start of the test part on, 'train_val' before."""
    return df.withColumn("split", F.when(F.col(date) >= F.lit(test_start), "test").otherwise("train_val"))


def fold_days(spark: SparkSession, plan: FoldPlan) -> DataFrame:
    """One row per day, fold and split."""
    parts = []
    for f in plan.folds:
        parts.append((f.fold, "train", f.train_start, f.train_end))
        parts.append((f.fold, "validation", f.train_end, f.val_end))
    bounds = spark.createDataFrame(parts, "fold bigint, split string, since date, before date")
    # windows of less than a day can be empty, and a sequence would run backwards through them
    return bounds.where("since < before").select("fold", "split", F.explode(F.sequence("since", F.date_sub("before", 1))).alias("date"))


def day_entries(plan: FoldPlan) -> int:
    """Exact number of rows of :func:`fold_days`, known before anything runs."""
    return sum((f.val_end - f.train_start).days for f in plan.folds)


def assign_folds(df: DataFrame, plan: FoldPlan, date: str = "date", split: str | None = None) -> DataFrame:
    """Rows with ``fold`` and ``split``, once for every window they belong to.

    ``split='validation'`` keeps the validation windows only, which never overlap, so that no
    row is repeated.
    """
    days = fold_days(df.sparkSession, plan).withColumnRenamed("date", date)
    if split is not None:
        days = days.where(F.col("split") == split)
    if day_entries(plan) <= MAX_BROADCAST_DAYS:
        days = F.broadcast(days)
    return df.join(days, date)


def fold_bounds(df: DataFrame, plan: FoldPlan, date: str = "date") -> DataFrame:
    """First day, last day and rows of every fold and split.

    Rows are counted per day first, so only the days are repeated over the folds.
    """
    per_day = df.groupBy(date).agg(F.count("*").alias("day_rows"))
    return (
        assign_folds(per_day, plan, date)
        .groupBy("fold", "split")
        .agg(
            F.min(date).alias("first_day"),
            F.max(date).alias("last_day"),
            F.sum("day_rows").alias("rows"),
        )
    )


def fold_counts(df: DataFrame, plan: FoldPlan, date: str = "date") -> DataFrame:
    """Rows per fold and split, zero included, and whether the fold can be used."""
    counts = fold_bounds(df, plan, date)
    rows_of = {
        name: F.coalesce(F.sum(F.when(F.col("split") == name, F.col("rows"))), F.lit(0)) for name in ("train", "validation")
    }
    per_fold = counts.groupBy("fold").agg(rows_of["train"].alias("train_rows"), rows_of["validation"].alias("val_rows"))
    return (
        plan_table(df.sparkSession, plan)
        .select("fold")
        .join(per_fold, "fold", "left")
        .na.fill(0, ["train_rows", "val_rows"])
        .withColumn("usable", (F.col("train_rows") > 0) & (F.col("val_rows") > 0))
    )


def usable_folds(df: DataFrame, plan: FoldPlan, date: str = "date") -> tuple[FoldPlan, dict]:
    """The plan up to the first fold that has an empty window, and the bounds of its windows.

    Bounds are rows of :func:`fold_bounds` by fold and split, two per fold.
    """
    bounds = {(row["fold"], row["split"]): row for row in fold_bounds(df, plan, date).collect()}
    folds = []
    for fold in plan.folds:
        if (fold.fold, "train") not in bounds or (fold.fold, "validation") not in bounds:
            break
        folds.append(fold)
    if not folds:
        raise WindowSizeError("no_folds", "no fold has rows in both of its windows")
    return FoldPlan(plan.first_day, plan.test_start, plan.last_day, tuple(folds)), bounds
