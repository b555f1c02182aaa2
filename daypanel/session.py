"""Local Spark session for tests and benchmarks; on a cluster the session comes from outside."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, name: str = "daypanel") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
