"""Panels stored by series: a fixed number of buckets, so that windows and joins by series need no shuffle.

The rows are moved once, by the writer. Every later job that partitions by the series (history,
gap filling, joins with clients or with another panel of as many buckets) reads each bucket as
one partition and starts at once. Within a bucket rows are split by calendar month, so a filter
on the day still prunes folders.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.sources.tables import PERIOD_COLUMN, between

_LAYOUT = "id string, key string, date string, buckets int, columns string"


def write_clustered(
    df: DataFrame, path: str, buckets: int | None = None, key: str = "client_id", date: str = "date"
) -> None:
    """Store a panel in ``buckets`` buckets by series, replacing what ``path`` held.

    ``buckets`` defaults to the session's shuffle partitions; choose it so that a bucket of the
    months that are usually read together fits a task. The rebalance uses the hash of the buckets:
    a task writes whole buckets, unless adaptive execution splits one that is far heavier than the
    others, so a series with a third of all rows is written by several tasks. Rows without a series
    or without a day are kept.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if PERIOD_COLUMN in df.columns:
        raise ValueError(f"the column {PERIOD_COLUMN!r} is the month of the layout")
    layout = uuid.uuid4().hex
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    table = _table_name(path, layout)
    (
        df.withColumn(PERIOD_COLUMN, F.date_format(date, "yyyy-MM"))
        .hint("rebalance", buckets, key)
        .write.mode("overwrite")
        .partitionBy(PERIOD_COLUMN)
        .bucketBy(buckets, key)
        .sortBy(key, date)
        .option("path", f"{path}/rows")
        .saveAsTable(table)
    )
    # written last: readers find the rows by it
    row = [(layout, key, date, buckets, columns.json())]
    spark.createDataFrame(row, _LAYOUT).coalesce(1).write.mode("overwrite").json(f"{path}/layout")


def read_clustered(spark: SparkSession, path: str, since=None, before=None) -> DataFrame:
    """Panel written by :func:`write_clustered`, cut to ``since <= date < before``.

    Buckets are known to the planner only through a table of the session's catalog. It is made from
    the stored layout where this session has not seen it; it is external, so dropping it
    leaves the rows alone.
    """
    stored = spark.read.schema(_LAYOUT).json(f"{path}/layout").first()
    table = _table_name(path, stored["id"])
    if not spark.catalog.tableExists(table):
        _register(spark, table, f"{path}/rows", stored)
    names = [field["name"] for field in json.loads(stored["columns"])["fields"]]
    return between(spark.table(table), since, before, stored["date"]).select(*[f"`{name}`" for name in names])


def _table_name(path: str, layout: str) -> str:
    return f"panel_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:16]}_{layout}"


def _register(spark: SparkSession, table: str, rows: str, stored) -> None:
    schema = T.StructType.fromJson(json.loads(stored["columns"])).add(PERIOD_COLUMN, T.StringType())
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    location = rows.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({PERIOD_COLUMN}) "
        f"CLUSTERED BY (`{stored['key']}`) SORTED BY (`{stored['key']}`, `{stored['date']}`) "
        f"INTO {stored['buckets']} BUCKETS LOCATION '{location}'"
    )
    spark.catalog.recoverPartitions(table)
