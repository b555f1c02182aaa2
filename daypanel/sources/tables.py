"""Typed CSV and parquet readers and writers for the panel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLIENT_SCHEMA = T.StructType([
    T.StructField("client_id", T.StringType()),
    T.StructField("region", T.StringType()),
])
CLIMATE_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("region", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
])
READING_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("consumption_kwh", T.DoubleType()),
])

PERIOD_COLUMN = "period"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False, mode: str = "FAILFAST"
) -> DataFrame:
    """CSV with a header line. A schema keeps the scan to one pass; inference needs two.

    A row that doesn't fit the schema is an error; ``mode="PERMISSIVE"`` turns its bad cells into NULL.
    """
    reader = spark.read.option("header", True).option("mode", mode)
    if schema is not None:
        # a header that disagrees with the schema is an error, not a shifted column
        reader = reader.schema(schema).option("enforceSchema", False)
    elif infer:
        reader = reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing readings are NULL everywhere after ingest, so no NaN reaches an aggregate."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    cleaned = {name: F.when(~F.isnan(name), F.col(name)) for name in floats}
    return df.withColumns(cleaned) if cleaned else df


def day(column: str) -> F.Column:
    """Calendar day of a date, timestamp or date text; text that is no date becomes NULL."""
    return F.col(column).try_cast("date")


def replace_view(df: DataFrame, name: str) -> DataFrame:
    """Register the frame under a name, replacing an earlier one; nothing is computed yet."""
    df.createOrReplaceTempView(name)
    return df


def write_panel(
    df: DataFrame, path: str, key: str = "client_id", date: str = "date", by_month: bool = False
) -> None:
    """Parquet laid out by calendar month, rows of a month sorted by series and day.

    A date filter prunes whole months. The rebalance lets adaptive execution split a heavy
    month over several writers and merge light ones, so file sizes follow the data and not
    the number of tasks times the number of months. Rows that were read from such a table and
    went through no shuffle since are ``by_month`` already and are written where they are.
    """
    rows = df.withColumn(PERIOD_COLUMN, F.date_format(date, "yyyy-MM"))
    if not by_month:
        rows = rows.hint("rebalance", PERIOD_COLUMN)
    (
        rows.sortWithinPartitions(PERIOD_COLUMN, key, date)
        .write.mode("overwrite")
        .partitionBy(PERIOD_COLUMN)
        .parquet(path)
    )


def read_panel(spark: SparkSession, path: str, since=None, before=None, date: str = "date") -> DataFrame:
    """Panel written by :func:`write_panel`, cut to ``since <= date < before``."""
    return between(spark.read.parquet(path), since, before, date).drop(PERIOD_COLUMN)


def between(df: DataFrame, since=None, before=None, date: str = "date") -> DataFrame:
    """Rows with ``since <= date < before`` of a table that is stored by month; whole months are pruned."""
    if since is not None:
        df = df.where(F.col(PERIOD_COLUMN) >= f"{since:%Y-%m}").where(F.col(date) >= F.lit(since))
    if before is not None:
        df = df.where(F.col(PERIOD_COLUMN) <= f"{before:%Y-%m}").where(F.col(date) < F.lit(before))
    return df


def write_splits(parts: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Train, validation and test rows in one table with a folder per part."""
    labelled = None
    for name, part in parts.items():
        part = part.withColumn("split", F.lit(name))
        labelled = part if labelled is None else labelled.unionByName(part)
    writer = labelled.write.mode("overwrite").partitionBy("split").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def read_split(
    spark: SparkSession, path: str, split: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """One part of a split table; the filter on ``split`` prunes the other folders."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV split needs a schema")
        reader = reader.option("header", True).schema(
            T.StructType([*schema.fields, T.StructField("split", T.StringType())])
        )
    return reader.load(path).where(F.col("split") == split).drop("split")
