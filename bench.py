"""Time the headline queries and the two jobs that have a recorded baseline.

Prints one JSON line. ``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the threads
and ``BENCH_QUERIES`` may name a few entries to run alone.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from daypanel.catalog.queries import QUERIES
from daypanel.plans import jobs
from daypanel.plans.forecaster import ALL_FEATURES, Settings
from daypanel.session import local_session
from daypanel.sources import panels, tables

HEADLINE = [
    "feature_table", "global_table", "global_table_long", "lag_features", "rolling_mean", "history_of_raw_lines",
    "impute_climate", "impute_climate_long", "calendar_table", "readings_with_climate", "holdout_split",
    "walk_forward_assign", "fold_bounds", "metrics_global", "client_metrics", "mase_pooled", "mase_by_series",
    "fold_metrics_naive", "test_evaluation", "series_long", "client_role_series", "category_index", "run_children",
    "newest_child_run", "parquet_sink_roundtrip", "split_sink_roundtrip", "csv_scan",
]
INGEST, INGEST_LONG, TRAIN = "job_ingest_features_parquet", "job_ingest_long_panel", "job_walk_forward_2_folds"
# thirty days of readings: two validation windows before the test part
SIZES = jobs.WindowSizes("14 days", "4 days", "5 days")
SETTINGS = Settings(features=tuple(ALL_FEATURES))
RAW = {"clients": tables.CLIENT_SCHEMA, "climate": tables.CLIMATE_SCHEMA, "readings": tables.READING_SCHEMA}


def timed(work) -> float:
    began = time.perf_counter()
    work()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    only = os.environ.get("BENCH_QUERIES", "").split()
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "daypanel-bench")

    def run(name):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("calendar_table")  # the first query of a session also loads its classes
    seconds = {name: timed(lambda: run(name)) for name in HEADLINE if not only or name in only}

    rates = {}

    def ingest(job, sources) -> str:
        """Time everything from CSV files to the stored global table; the files are made untimed."""
        folder = tempfile.mkdtemp(prefix="daypanel-bench-")
        for name, source in zip(RAW, sources):
            tables.write_csv(source(spark, sf_dir).select(RAW[name].fieldNames()), f"{folder}/{name}")
        inputs = jobs.read_inputs(spark, *[f"{folder}/{name}" for name in RAW])
        seconds[job] = timed(lambda: jobs.build_features(*inputs, f"{folder}/out"))
        rates[job] = round(tables.read_panel(spark, f"{folder}/out/global").count() / seconds[job])
        return f"{folder}/out"

    if not only or INGEST_LONG in only:
        ingest(INGEST_LONG, (panels.long_clients, panels.long_climate, panels.long_readings))
    if not only or {INGEST, TRAIN} & set(only):
        stored = ingest(INGEST, (panels.clients, panels.climate, panels.readings))
        if not only or TRAIN in only:
            seconds[TRAIN] = timed(lambda: jobs.train(spark, stored, SIZES, SETTINGS))
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"), "rows_per_second": rates,
    }))


if __name__ == "__main__":
    main()
