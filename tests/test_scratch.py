from types import SimpleNamespace

import pytest

from daypanel.sources.scratch import checkpointed, materialised, new_path, shared_dir


def session(named=None, current=None, master="yarn"):
    """A stand-in that only knows what the choice of the folder depends on."""
    chosen = []
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: chosen[-1] if chosen else current,
        setCheckpointDir=chosen.append,
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=context), chosen


def test_the_folder_named_by_the_cluster_is_used():
    spark, chosen = session(named="hdfs:///shared/checkpoints")
    assert shared_dir(spark) == "hdfs:///shared/checkpoints" and chosen == ["hdfs:///shared/checkpoints"]
    assert new_path(spark, "x").startswith("hdfs:///shared/checkpoints/x-")


def test_a_folder_set_before_is_kept():
    spark, chosen = session(named="hdfs:///a", current="hdfs:///a/1")
    assert shared_dir(spark) == "hdfs:///a" and chosen == []
    assert shared_dir(session(current="hdfs:///b/2")[0]) == "hdfs:///b/2"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session()[0])


def test_only_a_local_session_gets_a_temporary_folder():
    spark, chosen = session(master="local[4]")
    assert shared_dir(spark) == chosen[0]


def test_stored_rows_are_the_rows(spark):
    df = spark.range(100).withColumnRenamed("id", "n")
    for stored in (materialised(df, "rows"), checkpointed(df)):
        assert stored.schema == df.schema or stored.columns == df.columns
        assert sorted(r["n"] for r in stored.collect()) == list(range(100))


def test_a_small_stored_table_is_broadcast_and_a_large_one_is_not(spark):
    left, right = spark.range(1000), materialised(spark.range(1000), "right")
    joined = left.join(right, "id")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
        assert "SortMergeJoin" in left.join(right, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
