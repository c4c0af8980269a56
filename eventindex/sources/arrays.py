"""Arrays exported per event, and read back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventindex.functions.arrays import parse_numbers


def export_arrays(arrays: DataFrame, path: str, key: str = "event_key",
                  partition_by: str = "event_date", layout: str = "parquet") -> None:
    """Append the arrays whose key is not exported yet. `layout="text"` writes the numbers as
    whitespace-separated text beside their key."""
    spark = arrays.sparkSession
    new = arrays
    try:
        done = spark.read.format("csv" if layout == "text" else layout).option(
            "header", "true").load(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        new = arrays.join(done.select(F.col(key).cast(arrays.schema[key].dataType)), key,
                          "left_anti")
    if layout == "text":
        new = new.withColumn("data", F.array_join(F.col("data").cast("array<string>"), " "))
    (new.write.mode("append").partitionBy(partition_by).option("header", "true")
     .format("csv" if layout == "text" else layout).save(path))


def read_arrays(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_text_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Exported text; `schema` names the columns, with `data` as STRING."""
    return (spark.read.schema(schema).option("header", "true").csv(path)
            .withColumn("data", parse_numbers(F.col("data"))))
