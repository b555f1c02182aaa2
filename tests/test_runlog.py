"""The run log: whole commits, several writers, compaction."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from daypanel.plans import runlog


def finished(name, parent=None, **metrics):
    run = runlog.Run("trial", name, parent)
    run.note(names=["a", "b"], size=3)
    run.measure(metrics)
    run.close(runlog.FINISHED)
    return run


def family(number):
    parent = finished(f"parent_{number}", mae=float(number))
    return [parent, *[finished(f"Fold_{k}", parent.run_id, mae=float(k), rmse=2.0) for k in (1, 2)]]


def data_files(path):
    return [p for p in Path(path, "commits").rglob("*.parquet") if "_temporary" not in p.parts]


def counts(spark, path):
    return tuple(read(spark, path).count() for read in (runlog.runs, runlog.params, runlog.metrics))


def test_a_commit_is_one_file_with_everything(spark, tmp_path):
    runs = family(1)
    runlog.append(spark, str(tmp_path), runs)
    assert len(data_files(tmp_path)) == 1 and counts(spark, str(tmp_path)) == (3, 6, 5)
    stored = {r["run_id"]: r for r in runlog.runs(spark, str(tmp_path)).collect()}
    assert {r.run_id for r in runs} == set(stored)
    assert stored[runs[1].run_id]["parent_run_id"] == runs[0].run_id
    assert runlog.metrics(spark, str(tmp_path)).columns == ["run_id", "key", "value", "ts"]
    assert {r["value"] for r in runlog.params(spark, str(tmp_path)).where("key = 'names'").collect()} == {"['a', 'b']"}


def test_a_log_without_runs_is_empty(spark, tmp_path):
    assert counts(spark, str(tmp_path)) == (0, 0, 0) and runlog.compact(spark, str(tmp_path)) == 0


def test_a_run_without_metrics_or_parameters(spark, tmp_path):
    run = runlog.Run("trial", "bare")
    run.close(runlog.FAILED)
    runlog.append(spark, str(tmp_path), [run])
    assert counts(spark, str(tmp_path)) == (1, 0, 0)


def test_a_commit_that_dies_shows_no_run(spark, tmp_path):
    """What a dead writer leaves are files below _temporary; a row that cannot be written leaves no more."""
    path = str(tmp_path)
    runlog.append(spark, path, family(1))
    written = data_files(tmp_path)[0].read_bytes()
    left = tmp_path / "commits" / "commit=dead" / "_temporary" / "0" / "task_0"
    left.mkdir(parents=True)
    (left / "part-00000.parquet").write_bytes(written[: len(written) // 2])
    broken = family(2)
    broken[-1].metrics["mae"] = "no number"
    with pytest.raises(Exception):
        runlog.append(spark, path, broken)
    assert counts(spark, path) == (3, 6, 5)
    runlog.append(spark, path, family(3))
    assert counts(spark, path) == (6, 12, 10)


def test_writers_at_once_lose_nothing(spark, tmp_path):
    path = str(tmp_path)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda n: runlog.append(spark, path, family(n)), range(12)))
    assert counts(spark, path) == (36, 72, 60)


def test_a_commit_that_is_repeated_counts_once(spark, tmp_path):
    runs = family(1)
    for _ in range(2):
        runlog.append(spark, str(tmp_path), runs)
    assert counts(spark, str(tmp_path)) == (3, 6, 5)


def test_compaction(spark, tmp_path):
    path = str(tmp_path)
    for number in range(5):
        runlog.append(spark, path, family(number))
    before = {r["run_id"]: r.asDict() for r in runlog.runs(spark, path).collect()}
    assert runlog.compact(spark, path) == 5
    assert counts(spark, path) == (15, 30, 25) and len(data_files(path)) == 6

    # commits that arrive between two calls stay; those gathered before go
    late = family(9)
    runlog.append(spark, path, late)
    assert runlog.compact(spark, path) == 2
    assert counts(spark, path) == (18, 36, 30) and len(data_files(path)) == 3
    runlog.compact(spark, path)
    assert counts(spark, path) == (18, 36, 30) and len(data_files(path)) == 1
    after = {r["run_id"]: r.asDict() for r in runlog.runs(spark, path).collect()}
    assert {k: after[k] for k in before} == before and {r.run_id for r in late} <= set(after)


def test_a_compaction_that_dies_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    for number in range(3):
        runlog.append(spark, path, family(number))

    def lost(rows, schema):
        if rows:  # the note of what was gathered, after the new commit was written
            raise RuntimeError("driver lost")
        return create(rows, schema)

    create = spark.createDataFrame
    monkeypatch.setattr(spark, "createDataFrame", lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        runlog.compact(spark, path)
    monkeypatch.undo()
    assert counts(spark, path) == (9, 18, 15) and len(data_files(path)) == 4
    runlog.compact(spark, path)
    runlog.compact(spark, path)
    assert counts(spark, path) == (9, 18, 15) and len(data_files(path)) == 1


def test_writers_beside_a_compaction_lose_nothing(spark, tmp_path):
    path = str(tmp_path)
    for number in range(4):
        runlog.append(spark, path, family(number))
    with ThreadPoolExecutor(4) as pool:
        writers = [pool.submit(runlog.append, spark, path, family(n)) for n in range(4, 10)]
        pool.submit(runlog.compact, spark, path).result()
        [w.result() for w in writers]
    runlog.compact(spark, path)
    assert counts(spark, path) == (30, 60, 50)
    newest = runlog.latest_named(runlog.runs(spark, path), "trial", "parent_9").first()
    assert runlog.runs(spark, path).where(F.col("parent_run_id") == newest["run_id"]).count() == 2
