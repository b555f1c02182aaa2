"""Panels derived from the given tables: clients, readings, climate, a long panel, a run log.

Daily totals are summed as decimals, so the same total comes out whatever the order in which
partial sums meet. Each total is pre-aggregated on the map side, so a user or supplier that
owns a third of the raw rows reaches the shuffle as one row per day and task. After that every
series holds at most one row per calendar day, which bounds the size of each window partition
by the length of the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.functions.calendar import BRAZIL_HOLIDAYS_2023, month_day

_AMOUNT = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the name of their region."""
    return _with_region(spark, sf_dir, table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("client_id"), F.col("c_nationkey").alias("nation")
    ))


def long_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with the name of their region."""
    return _with_region(spark, sf_dir, table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("client_id"), F.col("s_nationkey").alias("nation")
    ))


def _with_region(spark: SparkSession, sf_dir: str, members: DataFrame) -> DataFrame:
    return (
        members.join(table(spark, sf_dir, "nation"), F.col("nation") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("client_id", F.col("r_name").alias("region"))
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event value of each user: one month, one row per user and day."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("client_id"), F.col("ts").cast("date").alias("date"))
        .agg(F.sum(F.col("value").cast(_AMOUNT)).cast("double").alias("consumption_kwh"))
    )


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily figures of each region, from the events of its customers."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("client_id"), F.col("ts").cast("date").alias("date"), F.col("value").alias("amount")
    )
    return _regional(events, clients(spark, sf_dir))


def long_climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily figures of each region, from the lines of its suppliers."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("client_id"), F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").alias("amount"),
    )
    return _regional(lines, long_clients(spark, sf_dir))


def _regional(facts: DataFrame, members: DataFrame) -> DataFrame:
    """Totals per region and day with a regular pattern of missing temperatures.

    Facts are first summed per client and day, so that the join carries daily rows and the few
    regions never meet the raw facts.
    """
    daily = facts.groupBy("client_id", "date").agg(
        F.sum(F.col("amount").cast(_AMOUNT)).alias("total"), F.count("*").alias("hits")
    )
    missing = (F.dayofmonth("date") + F.length("region")) % 7 < 3
    return (
        daily.join(members, "client_id")
        .groupBy("region", "date")
        .agg(F.sum("total").cast("double").alias("total"), F.sum("hits").cast("double").alias("humidity"))
        .select("date", "region", F.when(~missing, F.col("total") / 10).alias("temperature"), "humidity")
    )


def long_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily shipped quantity of each supplier over almost seven years."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("client_id"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(F.sum(F.col("l_quantity").cast(_AMOUNT)).cast("double").alias("consumption_kwh"))
    )


def long_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct days of the long panel."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()


def holidays_of(days: DataFrame) -> DataFrame:
    """The fixed holidays repeated in every year of a table of days."""
    recurring = sorted({int(text[5:7]) * 100 + int(text[8:10]) for text in BRAZIL_HOLIDAYS_2023})
    return days.where(month_day("date").isin(recurring)).select("date")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as parent runs and their lines as fold runs."""
    parents = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("r"), F.col("o_orderkey")).alias("run_id"),
        F.lit(None).cast("string").alias("parent_run_id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderdate").cast("date").alias("start_dt"),
        F.col("o_orderkey").alias("seq"),
    )
    children = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_shipdate").cast("date").alias("start_dt"))
        .select(
            F.concat(F.lit("r"), F.col("l_orderkey"), F.lit("_"), F.col("l_linenumber")).alias("run_id"),
            F.concat(F.lit("r"), F.col("l_orderkey")).alias("parent_run_id"),
            F.concat(F.lit("Fold_"), F.col("l_linenumber")).alias("name"),
            "start_dt",
            F.col("l_orderkey").alias("seq"),
        )
    )
    return parents.unionByName(children)
