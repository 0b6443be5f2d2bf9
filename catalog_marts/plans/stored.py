"""Reports kept as tables, with the order of their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POSITION = "position"


def store_report(report: DataFrame, path: str) -> None:
    """Write a sorted report: its files, and the rows in them, are in the order of the report."""
    if POSITION in report.columns:
        raise ValueError(f"a report has no column {POSITION}")
    report.write.mode("overwrite").parquet(path)


def open_report(spark: SparkSession, path: str) -> DataFrame:
    """A stored report with ``position``, its row numbers from 1.

    The number is that of the row in its file plus the rows of the files before, so that a long
    report is numbered in many tasks; only one count per file meets in one.
    """
    rows = spark.read.parquet(path)
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = rows.join(files, "_file").withColumn(POSITION, F.col("_before") + F.col("_row") + 1)
    return numbered.drop("_file", "_row", "_before")
