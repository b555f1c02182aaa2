from datetime import date, timedelta

import pytest

from daypanel.operators.folds import (
    Fold, FoldPlan, WindowSizeError, assign_folds, fold_bounds, fold_counts, fold_plan_of, holdout, plan_folds,
    usable_folds,
)

FIRST, LAST = date(2023, 1, 1), date(2023, 6, 30)


def daily(spark, first=FIRST, last=LAST, skip=lambda d: False, clients=("a", "b")):
    days = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    rows = [(c, d, 1.0) for c in clients for d in days if not skip(d)]
    return spark.createDataFrame(rows, "client_id string, date date, total_consumption double")


def test_golden_bounds(spark):
    df = daily(spark)
    plan = fold_plan_of(df, "2 months", "1 month", "1 month")
    assert plan.test_start == date(2023, 5, 30)
    bounds = {(r["fold"], r["split"]): (r["first_day"], r["last_day"]) for r in fold_bounds(df, plan).collect()}
    assert bounds == {
        (1, "train"): (FIRST, date(2023, 2, 28)),
        (1, "validation"): (date(2023, 3, 1), date(2023, 3, 31)),
        (2, "train"): (FIRST, date(2023, 3, 31)),
        (2, "validation"): (date(2023, 4, 1), date(2023, 4, 30)),
    }


def test_clipped_months_stay_clipped():
    plan = plan_folds(date(2023, 1, 31), date(2023, 12, 31), date(2023, 11, 29), "1 month", "1 month", "1 month")
    assert [f.train_end.day for f in plan.folds] == [28] * len(plan.folds)


@pytest.mark.parametrize("sizes, reason", [
    (("6 months", "1 month", "1 month"), "initial_train_size"),
    (("2 months", "4 months", "1 month"), "validation_size"),
    (("2 months", "1 month", "2 years"), "empty_train_val"),
    (("2 months", "0 days", "1 month"), "validation_size"),
])
def test_sizes_that_do_not_fit(spark, sizes, reason):
    with pytest.raises(WindowSizeError) as error:
        fold_plan_of(daily(spark), *sizes)
    assert error.value.reason == reason


def test_no_rows_at_all(spark):
    with pytest.raises(WindowSizeError):
        fold_plan_of(daily(spark, clients=()), "2 months", "1 month", "1 month")


def test_parts_are_disjoint(spark):
    df = daily(spark)
    plan = fold_plan_of(df, "2 months", "1 month", "1 month")
    split = {r["date"]: r["split"] for r in holdout(df, plan.test_start).collect()}
    assert all((d >= plan.test_start) == (s == "test") for d, s in split.items())
    rows = assign_folds(df, plan).collect()
    for fold in plan.folds:
        train = {(r["client_id"], r["date"]) for r in rows if r["fold"] == fold.fold and r["split"] == "train"}
        held = {(r["client_id"], r["date"]) for r in rows if r["fold"] == fold.fold and r["split"] == "validation"}
        assert train and held and not train & held and max(d for _, d in train) < min(d for _, d in held)


def test_an_empty_validation_window_ends_the_walk(spark):
    df = daily(spark, last=date(2023, 8, 31), skip=lambda d: d.month == 4)
    plan = fold_plan_of(df, "2 months", "1 month", "1 month")
    assert len(plan.folds) > 2
    usable = {r["fold"]: r["usable"] for r in fold_counts(df, plan).collect()}
    assert usable[1] and not usable[2]
    assert [f.fold for f in usable_folds(df, plan)[0].folds] == [1]


def test_no_usable_fold(spark):
    hole = FoldPlan(FIRST, LAST, LAST, (Fold(1, FIRST, date(2024, 1, 1), date(2024, 2, 1)),))
    with pytest.raises(WindowSizeError):
        usable_folds(daily(spark), hole)


def test_windows_shorter_than_a_day(spark):
    df = daily(spark, last=date(2023, 1, 6))
    plan = fold_plan_of(df, "36 hours", "12 hours", "1 day")
    usable = {r["fold"]: (r["train_rows"], r["val_rows"]) for r in fold_counts(df, plan).collect()}
    assert plan.folds[0].train_end == plan.folds[0].val_end == date(2023, 1, 3)
    assert usable[1] == (4, 0) and usable[2] == (4, 2)
