"""Filling missing values of ordered groups: linear by position, forward, backward.

The nearest known value on either side is a running ``last(…, ignorenulls)``, once in each
direction. Running frames read a partition once; a frame that is open towards the end would be
evaluated anew for every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.operators.blocks import BLOCK, MAX_SERIES_ROWS, TIE, block_count, in_blocks, split_long

_HELPERS = ["_pos", "_prev", "_next"]
_SPREAD = "_spread"


def linear(value: str) -> Column:
    """Known values stay; gaps are interpolated by position, the end holds the last value."""
    before, after = F.col("_prev"), F.col("_next")
    share = (F.col("_pos") - before["pos"]) / (after["pos"] - before["pos"])
    between = before["known"] + (after["known"] - before["known"]) * share
    return F.when(F.col(value).isNotNull(), F.col(value)).when(after.isNull(), before["known"]).otherwise(between)


def forward(value: str) -> Column:
    """The last known value up to the row."""
    return F.coalesce(F.col(value), F.col("_prev")["known"])


def backward(value: str) -> Column:
    """The first known value from the row on."""
    return F.coalesce(F.col(value), F.col("_next")["known"])


def treated(value: str) -> Column:
    """Linear, then forward, then backward: only a group without any value stays empty."""
    return F.coalesce(linear(value), F.col("_prev")["known"], F.col("_next")["known"])


def fill_gaps(
    df: DataFrame,
    filled: dict[str, Column],
    key: str = "region",
    order: Sequence[str] = ("date",),
    value: str = "temperature",
    long_keys: DataFrame | None = None,
    max_series_rows: int = MAX_SERIES_ROWS,
) -> DataFrame:
    """Add or replace the columns in ``filled``, built from the functions above.

    Rows without a key form no group: their columns become NULL. ``long_keys`` names the groups
    that do not fit one task (see :mod:`daypanel.operators.blocks`).
    """
    filled = {name: F.when(F.col(key).isNotNull(), column) for name, column in filled.items()}
    if long_keys is None:
        return _neighbours(df, [key], key, order, value).withColumns(filled).drop(*_HELPERS)
    rest, heavy = split_long(df, key, long_keys)
    blocks = in_blocks(heavy, [key, *order], block_count(long_keys, max_series_rows))
    lifted = _carry_over(_neighbours(blocks, [key, BLOCK], key, [*order, TIE], value), key)
    return (
        _neighbours(rest, [key], key, order, value)
        .unionByName(lifted.select(*df.columns, *_HELPERS))
        .withColumns(filled)
        .drop(*_HELPERS)
    )


def impute_climate(climate: DataFrame, **options) -> DataFrame:
    """Climate rows with the gaps of ``temperature`` filled per region; humidity is untouched."""
    return fill_gaps(climate, {"temperature": treated("temperature")}, **options)


def _neighbours(df: DataFrame, group: list[str], key: str, order: Sequence[str], value: str) -> DataFrame:
    # rows without a key would all meet in one partition, so they are spread by their order
    spread = df.withColumn(_SPREAD, F.when(F.col(key).isNull(), F.xxhash64(*order)))
    whole = Window.partitionBy(*group, _SPREAD)
    ahead = whole.orderBy(*order)
    numbered = spread.withColumn("_pos", F.row_number().over(ahead))
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("known"), F.col("_pos").alias("pos")))
    upto = ahead.rowsBetween(Window.unboundedPreceding, 0)
    back = whole.orderBy(F.col("_pos").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return numbered.withColumns({
        "_prev": F.last(known, ignorenulls=True).over(upto),
        "_next": F.last(known, ignorenulls=True).over(back),
    }).drop(_SPREAD)


def _carry_over(rows: DataFrame, key: str) -> DataFrame:
    """Make block-local neighbours those of the whole group."""
    edges = rows.groupBy(key, BLOCK).agg(
        F.count("*").alias("_rows"),
        F.max_by("_prev", "_pos").alias("_tail"),
        F.min_by("_next", "_pos").alias("_head"),
    )
    earlier = Window.partitionBy(key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(key).orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    lift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    carried = (
        edges.withColumn("_lift", lift)
        .withColumns({"_tail": _lifted("_tail"), "_head": _lifted("_head")})
        .select(
            key,
            BLOCK,
            "_lift",
            F.last("_tail", ignorenulls=True).over(earlier).alias("_before"),
            F.last("_head", ignorenulls=True).over(later).alias("_after"),
        )
    )
    return rows.join(carried, [key, BLOCK]).withColumns({
        "_prev": F.coalesce(_lifted("_prev"), F.col("_before")),
        "_next": F.coalesce(_lifted("_next"), F.col("_after")),
        "_pos": F.col("_pos") + F.col("_lift"),
    })


def _lifted(point: str) -> Column:
    """The same known value at its position in the whole group."""
    moved = F.struct(F.col(point)["known"].alias("known"), (F.col(point)["pos"] + F.col("_lift")).alias("pos"))
    return F.when(F.col(point).isNotNull(), moved)
