"""The run log: runs with their parameters and metrics, added by whole commits.

A commit is a folder of its own with one row per run, which carries the run's parameters and metrics. Its
rows are in one file, which the file system shows whole or not at all, so nobody sees half a run, and
writers never share a folder. A run counts once by its id, however many commits hold it: that makes
repeated commits harmless and lets :func:`compact` gather old commits in a new one while others read and
write.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.sources.scratch import remove

RUNS = (
    "experiment string, run_id string, parent_run_id string, name string, start_ts timestamp, end_ts timestamp, "
    "status string"
)
_ROW = f"{RUNS}, params map<string, string>, metrics map<string, double>"
_COMMIT, _GATHERED = "commit", "gathered"

FINISHED, FAILED = "FINISHED", "FAILED"


def now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class Run:
    """One run while it is going on; nothing is written before :func:`append`."""

    experiment: str
    name: str
    parent_run_id: str | None = None
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    start_ts: datetime = field(default_factory=now)
    end_ts: datetime | None = None
    status: str | None = None
    params: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, float] = field(default_factory=dict)

    def note(self, **params) -> None:
        self.params.update({key: str(value) for key, value in params.items()})

    def measure(self, metrics: Mapping[str, float | None]) -> None:
        self.metrics.update({key: float(value) for key, value in metrics.items() if value is not None})

    def close(self, status: str) -> None:
        self.end_ts, self.status = now(), status


def append(spark: SparkSession, path: str, runs: Sequence[Run]) -> None:
    """Commit finished runs with their parameters and metrics, all of them or none."""
    rows = [
        (r.experiment, r.run_id, r.parent_run_id, r.name, r.start_ts, r.end_ts, r.status, r.params, r.metrics) for r in runs
    ]
    spark.createDataFrame(rows, _ROW).coalesce(1).write.parquet(_folder(path, uuid.uuid4().hex))


def _folder(path: str, commit: str) -> str:
    return f"{path}/commits/{_COMMIT}={commit}"


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """Every row of every commit; without any commit yet it is empty."""
    return _stored(spark, f"{path}/commits", f"{_ROW}, {_COMMIT} string")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """Every run once."""
    return _commits(spark, path).drop(_COMMIT).dropDuplicates(["run_id"])


def compact(spark: SparkSession, path: str, file_runs: int = 1_000_000) -> int:
    """Gather all commits in a new one of few files and return how many it took the place of.

    It can run beside readers and writers and be stopped at any moment: the commits it gathers stay until
    the next call, which removes those that the call before had finished gathering. So a reader has the
    time between two calls to end, and commits that arrive meanwhile are left alone.
    """
    covered = _stored(spark, f"{path}/{_GATHERED}", f"{_COMMIT} string, by string")
    done = [row[_COMMIT] for row in covered.select(_COMMIT).distinct().toLocalIterator()]
    for commit in done:
        remove(spark, _folder(path, commit))
    remove(spark, f"{path}/{_GATHERED}")

    seen = [row[_COMMIT] for row in _commits(spark, path).select(_COMMIT).distinct().toLocalIterator()]
    if len(seen) < 2:
        return 0
    gathered = _commits(spark, path).where(F.col(_COMMIT).isin(seen)).drop(_COMMIT).dropDuplicates(["run_id"])
    new = uuid.uuid4().hex
    gathered.coalesce(1).write.option("maxRecordsPerFile", file_runs).parquet(_folder(path, new))
    # written last: only commits whose runs are all in the new one are ever removed
    names = spark.createDataFrame([(commit, new) for commit in seen], f"{_COMMIT} string, by string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{path}/{_GATHERED}")
    return len(seen)


@contextmanager
def recorded(spark: SparkSession, path: str, run: Run) -> Iterator[Run]:
    """Append ``run`` when the block ends: finished, or failed with its reason."""
    try:
        yield run
    except Exception as error:
        run.note(status=f"failed: {error}")
        run.close(FAILED)
        append(spark, path, [run])
        raise
    run.close(FINISHED)
    append(spark, path, [run])


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or an empty one where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def runs(spark: SparkSession, path: str) -> DataFrame:
    return _rows(spark, path).drop("params", "metrics")


def params(spark: SparkSession, path: str) -> DataFrame:
    return _rows(spark, path).select("run_id", F.explode("params"))


def metrics(spark: SparkSession, path: str) -> DataFrame:
    return _rows(spark, path).select("run_id", F.explode("metrics"), F.col("end_ts").alias("ts"))


def latest(found: DataFrame, *newest_first: Column) -> DataFrame:
    """The newest of the given runs, or no row; every task hands over a single candidate."""
    return found.orderBy(*newest_first).limit(1)


def latest_named(log: DataFrame, experiment: str, name: str) -> DataFrame:
    named = log.where((F.col("experiment") == experiment) & (F.col("name") == name))
    return latest(named, F.col("start_ts").desc(), F.col("run_id").desc())


def children(log: DataFrame) -> DataFrame:
    """Every child run beside its parent, with the fold number taken from its name."""
    parents = log.select(F.col("run_id").alias("parent_run_id"), F.col("name").alias("parent_name"))
    return log.join(parents, "parent_run_id").withColumn("fold", fold_number("name"))


def newest_children(log: DataFrame, *order: str) -> DataFrame:
    """The newest child of every parent; candidates are reduced before the shuffle."""
    key = F.struct(*order)
    newest = F.max_by(F.struct("run_id", "name"), key)
    return (
        log.where(F.col("parent_run_id").isNotNull())
        .groupBy("parent_run_id")
        .agg(newest.alias("newest"))
        .select("parent_run_id", "newest.run_id", "newest.name")
    )


def fold_number(name: str) -> Column:
    """The number behind the last underscore; names without one give NULL."""
    return F.element_at(F.split(name, "_"), -1).try_cast("int")


def text_list(column: str) -> Column:
    """A list of names that was stored as text, ``['a', 'b']``."""
    return text_list_of(F.col(column))


def text_list_of(text: Column) -> Column:
    return F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})
