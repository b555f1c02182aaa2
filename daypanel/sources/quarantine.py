"""CSV with bad rows set aside: good rows go on, bad ones are listed with file, line and reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.sources.scratch import new_path
from daypanel.sources.tables import nan_to_null

_LINE, _FILE = "_bad_line", "_bad_file"
LISTED = "file string, line bigint, text string, reason string"
# More bad files than this are not named in the scan's filter; all files are read for line numbers then.
NAMED_FILES = 1000


class BadRows(ValueError):
    """More rows than allowed do not fit the schema."""

    def __init__(self, rows: int, bad: int, quarantine: str):
        super().__init__(f"{bad} of {rows} rows do not fit the schema; they are listed in {quarantine}")
        self.rows, self.bad, self.quarantine = rows, bad, quarantine


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, quarantine: str, max_bad_share: float | None = 0.01
) -> DataFrame:
    """Rows of a CSV with header that fit ``schema``; the others are written to ``quarantine``.

    The files are parsed once: rows are stored typed in the shared folder and counted by that same write.
    A row is bad if it has more or fewer cells than the schema or a cell of another type; an empty cell is
    NULL and fits. The table at ``quarantine`` (``file``, ``line`` from 1 with the header as the first,
    ``text``, ``reason``) replaces the one of an earlier call and is empty if all rows fit. A
    share of bad rows above ``max_bad_share`` raises :class:`BadRows` after they were listed; None
    allows any. A header that disagrees with the schema is an error, as it is without quarantine.
    """
    taken = {_LINE, _FILE} & set(schema.fieldNames())
    if taken:
        raise ValueError(f"the schema has columns of the reader's own names: {sorted(taken)}")
    parsed = (
        spark.read.option("header", True).option("enforceSchema", False)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
        .schema(T.StructType([*schema.fields, T.StructField(_LINE, T.StringType())]))
        .csv(path)
    )
    counted, stored = Observation(), new_path(spark, "csv-rows")
    rows = parsed.select("*", F.col("_metadata.file_path").alias(_FILE))
    rows.observe(counted, F.count(F.lit(1)).alias("rows"), F.count(_LINE).alias("bad")).write.parquet(stored)
    typed = spark.read.schema(rows.schema).parquet(stored)

    found = counted.get
    if found["bad"]:
        bad = typed.where(F.col(_LINE).isNotNull()).groupBy(F.col(_FILE).alias("file"), F.col(_LINE).alias("text"))
        listed = _listed(spark, path, bad.agg(F.count("*").alias("copies")), schema)
    else:
        listed = spark.createDataFrame([], LISTED)
    listed.write.mode("overwrite").parquet(quarantine)
    if max_bad_share is not None and found["bad"] > max_bad_share * found["rows"]:
        raise BadRows(found["rows"], found["bad"], quarantine)
    return nan_to_null(typed.where(F.col(_LINE).isNull()).drop(_LINE, _FILE))


def _listed(spark: SparkSession, path: str, bad: DataFrame, schema: T.StructType) -> DataFrame:
    """Each bad line at its place. Lines of one file with the same text are all bad, so texts are matched once."""
    files = [row["file"] for row in bad.select("file").distinct().limit(NAMED_FILES + 1).collect()]
    lines = _numbered(spark, path, files if len(files) <= NAMED_FILES else None)
    # a text that the plain reader shows differently keeps its copies without a line
    copies = F.array_repeat(F.col("line"), F.when(F.col("line").isNull(), F.col("copies")).otherwise(1).cast("int"))
    return (
        bad.join(lines, ["file", "text"], "left")
        .select("file", F.explode(copies).alias("line"), "text", reason("text", schema).alias("reason"))
    )


def _numbered(spark: SparkSession, path: str, files: list[str] | None) -> DataFrame:
    """Lines with their numbers: the place in the piece of the file that a task reads, and the lines before that piece."""
    lines = spark.read.text(path)
    if files is not None:
        lines = lines.where(F.col("_metadata.file_path").isin(files))  # prunes the other files
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("piece"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("text"),
    )
    earlier = Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        lines.groupBy("file", "piece")
        .agg(F.min("at").alias("first"), F.count("*").alias("size"))
        .withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    )
    number = F.col("at") - F.col("first") + F.col("before") + 1
    return lines.join(pieces, ["file", "piece"]).select("file", "text", number.alias("line"))


def reason(text: str, schema: T.StructType) -> Column:
    """Why a line does not fit: its number of cells, or its first cell of another type."""
    cells = ", ".join(f"`{name}` string" for name in [*schema.fieldNames(), _LINE])
    read = F.from_csv(F.col(text), cells, {"columnNameOfCorruptRecord": _LINE})
    wrong = [
        F.when(
            read[f.name].isNotNull() & read[f.name].try_cast(f.dataType).isNull(),
            F.concat(F.lit(f"{f.name}: '"), read[f.name], F.lit(f"' is no {f.dataType.simpleString()}")),
        )
        for f in schema.fields
    ]
    return F.when(read[_LINE].isNotNull(), F.lit(f"not {len(schema.fields)} cells")).otherwise(
        F.coalesce(*wrong, F.lit("a cell does not fit its type"))
    )
