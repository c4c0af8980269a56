"""Image frames: dimensions from metadata, shape check, median filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventindex.functions.arrays import reshape
from eventindex.functions.numeric import median3x3
from eventindex.functions.values import dimension


def with_dimensions(df: DataFrame, metadata: str = "metadata") -> DataFrame:
    """Add width and height; rows without both are no images and are left out."""
    return (df.withColumn("width", dimension(F.col(metadata), "width"))
            .withColumn("height", dimension(F.col(metadata), "height"))
            .where("width IS NOT NULL AND height IS NOT NULL"))


def prepare_frames(df: DataFrame, metadata: str = "metadata", data: str = "data") -> DataFrame:
    """Median-filtered frames as rows of columns. Pixels stay inside arrays from scan to
    result: one row per frame, one Arrow exchange."""
    sized = with_dimensions(df, metadata)
    filtered = sized.withColumn("_flat", median3x3(data, "width", "height"))
    return (filtered.withColumn("frame", reshape(F.col("_flat"), F.col("width"), F.col("height")))
            .drop("_flat"))
