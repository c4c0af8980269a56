"""Array payloads of chosen events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEYS = ["event_date", "event_key", "dataset_name"]


def attach_payload(rows: DataFrame, payload: DataFrame) -> DataFrame:
    """Leaf rows with the array where there is no single value. The day is part of the join
    key, so a day filter on the rows prunes the payload's partitions too."""
    arrays = payload.select(*KEYS, F.col("data").alias("_data"))
    return (rows.join(arrays, KEYS, "left")
            .withColumn("data", F.when(F.col("value").isNull(), F.col("_data")))
            .drop("_data"))


def missing_payload(rows: DataFrame, payload: DataFrame) -> DataFrame:
    """Rows that need an array which is not stored."""
    return (rows.where("value IS NULL")
            .join(payload.select(*KEYS), KEYS, "left_anti"))
