"""Peak frequencies of projected frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventindex.functions.arrays import frequency_step, peak_bin, repair_axis, sample_variance
from eventindex.functions.numeric import column_peaks, projection_spectrum

BINS = 254  # fixed value: spectrum bins examined


def peak_frequency(df: DataFrame, data: str = "data", axis: str = "axis", width: str = "width",
                   height: str = "height", bins: int = BINS, digits: int | None = None
                   ) -> DataFrame:
    """Strongest frequency of every frame's projection, in GHz for an axis in picoseconds.
    Projection and transform share one Arrow exchange. `digits` rounds the amplitudes first,
    which settles near-ties the same way on every platform."""
    amplitudes = projection_spectrum(data, width, height, F.lit(bins))
    out = df.withColumn("spectrum", amplitudes)
    if digits is not None:
        out = out.withColumn("spectrum", F.transform("spectrum", lambda x: F.round(x, digits)))
    peak = peak_bin(F.col("spectrum"))
    step = frequency_step(repair_axis(F.col(axis), F.col(height)))
    return (out.withColumn("peak_bin", peak)
            .withColumn("max_amplitude", F.array_max("spectrum"))
            .withColumn("max_frequency", step * F.col("peak_bin")))


def above_threshold(df: DataFrame, metric: str, threshold: float) -> DataFrame:
    return df.where(F.col(metric) >= threshold)


def only_flagged(df: DataFrame, flagged: DataFrame, key: str = "event_key") -> DataFrame:
    return df.join(flagged.select(key), key, "left_semi")


def with_column_peaks(df: DataFrame, data: str = "data", width: str = "width",
                      height: str = "height") -> DataFrame:
    """Largest spectral amplitude of each frame column, and their sample variance."""
    return (df.withColumn("column_peaks", column_peaks(data, width, height))
            .withColumn("peak_variance", sample_variance(F.col("column_peaks"))))


def metric_series(df: DataFrame, metric: Column) -> DataFrame:
    """(event_ts, metric) in time order; the sort is range-partitioned over all executors."""
    return (df.select("event_ts", "event_key", metric.alias("metric"))
            .orderBy("event_ts", "event_key"))
