"""Lists of paths, separated by commas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_manifest(paths: DataFrame, out: str, column: str = "path") -> None:
    paths.select(column).write.mode("overwrite").option("lineSep", ",").text(out)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per listed path, blanks dropped. The comma is the record separator, so a large
    list is split between tasks like any text file."""
    return (spark.read.option("lineSep", ",").text(path)
            .select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("path"))
            .where("path <> ''"))
