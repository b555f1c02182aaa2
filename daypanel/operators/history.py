"""Features of a series' own past: day counter, lags, trailing means and deviations, difference.

All of them look back at most 15 rows, by row and not by calendar day, and never at the row
itself (the difference excepted).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daypanel.operators.blocks import BLOCK, MAX_SERIES_ROWS, TIE, block_count, in_blocks, split_long

LAGS = (1, 2, 3, 4, 7, 15)
ROLLING = (3, 7)
DEPTH = 15


def day_counter(window: WindowSpec) -> Column:
    return F.row_number().over(window).cast("bigint")


def lag_columns(value: str, window: WindowSpec) -> dict[str, Column]:
    return {f"consumption_lag_{k}": F.lag(value, k).over(window) for k in LAGS}


def rolling_means(value: str, window: WindowSpec) -> dict[str, Column]:
    return {f"rolling_mean_{k}": F.avg(value).over(window.rowsBetween(-k, -1)) for k in ROLLING}


def rolling_deviations(value: str, window: WindowSpec) -> dict[str, Column]:
    return {f"rolling_std_{k}": F.stddev_samp(value).over(window.rowsBetween(-k, -1)) for k in ROLLING}


def past_columns(value: str, window: WindowSpec) -> dict[str, Column]:
    return {
        **lag_columns(value, window),
        **rolling_means(value, window),
        **rolling_deviations(value, window),
    }


def difference(value: str) -> Column:
    return F.col(value) - F.col("consumption_lag_1")


def series_window(key: str = "client_id", order: Sequence[str] = ("date",)) -> WindowSpec:
    return Window.partitionBy(key).orderBy(*order)


def add_history(
    df: DataFrame, key: str = "client_id", order: Sequence[str] = ("date",), value: str = "total_consumption", **long_series
) -> DataFrame:
    """Add every history feature; all share one shuffle and one sort by series.

    Keyword arguments for long series are those of :func:`with_past`.
    """
    featured = with_past(df, past_columns, key, order, value, counter="day_counter", **long_series)
    return featured.withColumn("diff_lag_1", difference(value))


def with_past(
    df: DataFrame,
    columns: Callable[[str, WindowSpec], dict[str, Column]],
    key: str,
    order: Sequence[str],
    value: str,
    counter: str | None = None,
    long_keys: DataFrame | None = None,
    max_series_rows: int = MAX_SERIES_ROWS,
) -> DataFrame:
    """Add ``columns(value, window)`` and, if named, a row counter over each series.

    The columns may look back up to 15 rows. ``long_keys`` names the series that do not fit one
    task, as found by :func:`daypanel.operators.blocks.long_series`. Their rows go through
    consecutive blocks, each preceded by the last 15 values before it.
    """
    names = [*df.columns, *([counter] if counter else []), *columns(value, series_window(key, order))]

    def plain(rows: DataFrame) -> DataFrame:
        window = series_window(key, order)
        counted = {counter: day_counter(window)} if counter else {}
        return rows.withColumns({**counted, **columns(value, window)})

    if long_keys is None:
        return plain(df)
    rest, heavy = split_long(df, key, long_keys)
    blocks = in_blocks(heavy, [key, *order], block_count(long_keys, max_series_rows))
    total_order = [*order, TIE]
    window = Window.partitionBy(key, BLOCK).orderBy("_slot", *total_order)
    counted = F.sum(F.when(F.col("_slot") == 0, 1).otherwise(0)).over(window)
    earlier = F.coalesce(F.max("_earlier").over(window), F.lit(0))
    cut = (
        blocks.withColumn("_slot", F.lit(0))
        .unionByName(_lead_in(blocks, key, total_order, value), allowMissingColumns=True)
        .withColumns({**({counter: counted + earlier} if counter else {}), **columns(value, window)})
        .where(F.col("_slot") == 0)
    )
    return plain(rest).unionByName(cut.select(names))


def _lead_in(blocks: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Up to 15 rows in front of each block, at slots -15 … -1, and the rows counted so far.

    Fifteen blocks back always hold fifteen rows, since no block of a series is empty.
    """
    newest_first = Window.partitionBy(key, BLOCK).orderBy(*[F.col(name).desc() for name in order])
    tails = (
        blocks.select(key, BLOCK, *order, value)
        .withColumn("_back", F.row_number().over(newest_first))
        .where(F.col("_back") <= DEPTH)
        .groupBy(key, BLOCK)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("slot"), F.col(value).alias("y")))).alias("_tail"))
    )
    sizes = blocks.groupBy(key, BLOCK).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(key).orderBy(BLOCK)
    near = F.flatten(F.collect_list("_tail").over(earlier.rowsBetween(-DEPTH, -1)))
    before = F.sum("_rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    return (
        tails.join(sizes, [key, BLOCK])
        .select(key, BLOCK, F.slice(F.reverse(near), 1, DEPTH).alias("_near"), before.alias("_earlier"))
        .select(key, BLOCK, "_earlier", F.posexplode("_near").alias("_at", "_point"))
        .select(
            key,
            BLOCK,
            "_earlier",
            (-1 - F.col("_at")).alias("_slot"),
            F.col("_point")["y"].alias(value),
        )
    )
