"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from compare import differences, duck
from compare import SF_DIR
from daypanel.catalog.checks import CHECKS
from daypanel.catalog.queries import QUERIES, last_fold_model

MODEL_QUERIES = {"gbt_forecast", "fold_metrics_gbt"}


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_only_model_queries_lack_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())
    assert set(QUERIES) - set(CHECKS) == MODEL_QUERIES
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_rows_as_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, CHECKS[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_scores_are_whole_and_finite(spark):
    model, test = last_fold_model(spark, SF_DIR)
    rows = model.score(test.drop("total_consumption")).collect()
    assert rows and all(row["prediction"] is not None and abs(row["prediction"]) < 1e9 for row in rows)


def test_preview_is_in_order(spark):
    rows = [(row["dt"], row["client_id"]) for row in QUERIES["prediction_preview"](spark, SF_DIR).collect()]
    assert len(rows) == 5 and rows == sorted(rows)
