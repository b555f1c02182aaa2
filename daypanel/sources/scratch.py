"""Shared folder for checkpoints and intermediate tables.

Executors come and go, so anything a later stage re-reads has to sit in a folder all of them
see. The cluster names that folder in ``spark.checkpoint.dir``; only a local session, where
driver and executors are one process, may fall back to a temporary folder of the machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session; sets one only for a local session without any."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="daypanel-")
    context.setCheckpointDir(local)
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows are frozen in the shared folder and the lineage is cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialised(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The planner then knows the real size of the table. A join with it is broadcast only when
    it fits under ``spark.sql.autoBroadcastJoinThreshold`` and is shuffled otherwise, so small
    dimension tables need no hint that would break when they grow.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that no reader needs any more; one that is not there is no error."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
