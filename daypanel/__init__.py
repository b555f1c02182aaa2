"""Daily panel forecasting on Spark: features, folds, models, metrics and a run log."""

__version__ = "0.1.0"
