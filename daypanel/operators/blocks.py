"""Cutting series that are too long for one task into consecutive blocks.

A daily series has one row per calendar day, so a window partitioned by series is short by
nature. Readings that are not unique per day can make one series arbitrarily long. Those
series, and only those, are range-partitioned by series and order into blocks of about equal
size; what a block needs from the rows before or after it is computed from one summary row per
block and handed over by a join. Results are the same as with one unlimited window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypanel.sources.scratch import checkpointed, materialised

MAX_SERIES_ROWS = 4_000_000
BLOCK, TIE = "_block", "_tie"


def long_series(df: DataFrame, key: str, max_rows: int = MAX_SERIES_ROWS) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows, or None if there are none.

    The count reads the key column only and is combined before the shuffle. The keys stay in a
    table; joins with it are broadcast only while that table is small.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    found = counts.where(F.col("rows") > max_rows)
    return None if found.isEmpty() else materialised(found, "long-series")


def split_long(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary series and the rows of long ones."""
    only_keys = keys.select(key)
    return df.join(only_keys, key, "left_anti"), df.join(only_keys, key, "left_semi")


def in_blocks(df: DataFrame, order: Sequence[str], blocks: int) -> DataFrame:
    """Rows range-partitioned by ``order``, numbered by partition and frozen in a checkpoint.

    Block numbers rise with the order. Rows that are equal in it, exact copies included, are told
    apart by ``_tie``, so even those can be cut anywhere; windows over blocks order by it last.
    The rows are stored before they get that number and again before anyone reads the block:
    row positions and sampled range bounds are only certain for rows that no lost executor can
    bring back in another order.
    """
    numbered = materialised(df, "long-rows").withColumn(TIE, F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(blocks, *[F.col(name) for name in [*order, TIE]])
    return checkpointed(ranged.withColumn(BLOCK, F.spark_partition_id()))


def block_count(keys: DataFrame, max_rows: int) -> int:
    """Blocks needed so that a block stays well below the longest permitted series."""
    rows = keys.agg(F.sum("rows")).first()[0]
    return max(2, -(-rows * 2 // max_rows))


def dense_index(values: DataFrame, column: str, index: str = "index", one_task_rows: int = 100_000) -> DataFrame:
    """Number the distinct values of a column 0, 1, … in ascending order, NULL left out.

    Few values are numbered in one task. Many are range-partitioned, numbered within each
    partition and lifted by the sizes of the partitions before it.
    """
    distinct = materialised(values.where(F.col(column).isNotNull()).select(column).distinct(), "values")
    count = distinct.count()
    if count <= one_task_rows:
        return distinct.withColumn(index, F.row_number().over(Window.orderBy(column)).cast("bigint") - 1)
    ranged = in_blocks(distinct, [column], -(-count // one_task_rows))
    earlier = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    lifted = (
        ranged.groupBy(BLOCK)
        .count()
        .select(BLOCK, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_lift"))
    )
    position = F.row_number().over(Window.partitionBy(BLOCK).orderBy(column))
    return (
        ranged.withColumn("_position", position)
        .join(lifted, BLOCK)
        .select(column, (F.col("_position") + F.col("_lift") - 1).cast("bigint").alias(index))
    )
