"""The rank directory: how many events each hour holds, so that a position is found by descent.

Events are listed by (time, key). Counts per hour and their running sums tell in which hours the
wanted positions lie; only the rows of these hours are read and sorted, each hour by itself. An hour
of very many events is counted by minutes first. The counts that come to the driver are bounded by
the calendar, not by the number of events: hours of the range, and minutes of long hours in it.
"""

from __future__ import annotations

from datetime import datetime, timezone
from typing import NamedTuple
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventindex.functions.times import ZONE

HOUR, MINUTE = 3_600, 60
LONG_HOUR = 1_000_000    # events above which an hour is counted by minutes
MOST_INTERVALS = 32      # intervals of time written as conditions of the scan


class Bucket(NamedTuple):
    """Events of [start, start + width), in seconds of the epoch."""
    start: int
    width: int
    n: int
    before: int = 0


def bucket_start(width: int, ts: str = "event_ts") -> Column:
    return F.floor(F.unix_timestamp(F.col(ts)) / width) * width


def rank_directory(events: DataFrame, *by: str) -> DataFrame:
    """Events per hour, for each value of the `by` columns apart: start, n."""
    return events.groupBy(*by, bucket_start(HOUR).alias("start")).agg(F.count("*").alias("n"))


def _counts(rows: DataFrame, width: int) -> list[Bucket]:
    found = rows.groupBy(bucket_start(width).alias("start")).agg(F.count("*").alias("n")).collect()
    return [Bucket(r["start"], width, r["n"]) for r in found]


def _running(buckets: list[Bucket]) -> list[Bucket]:
    out, before = [], 0
    for b in sorted(buckets):
        out.append(b._replace(before=before))
        before += b.n
    return out


def _holding(buckets: list[Bucket], ranges: list[tuple[int, int]]) -> list[Bucket]:
    """Buckets that hold a position of one of the sorted, disjoint ranges."""
    out, k = [], 0
    for b in buckets:
        while k < len(ranges) and ranges[k][1] < b.before:
            k += 1
        if k < len(ranges) and ranges[k][0] < b.before + b.n:
            out.append(b)
    return out


def hours_of(events: DataFrame, directory: DataFrame | None, inner: tuple[int, int] | None) -> list[Bucket]:
    """Counts of all hours. Those whose start lies inside `inner` (seconds) are whole hours of the
    stored directory; the others, at the ends of a time range, are counted."""
    if directory is None:
        return _counts(events, HOUR)
    if inner is None:
        return [Bucket(r["start"], HOUR, r["n"]) for r in directory.groupBy("start").agg(F.sum("n").alias("n")).collect()]
    lo, hi = inner
    whole = directory.where((F.col("start") >= lo) & (F.col("start") < hi)).groupBy("start").agg(F.sum("n").alias("n"))
    at = F.unix_timestamp("event_ts")
    return ([Bucket(r["start"], HOUR, r["n"]) for r in whole.collect()]
            + _counts(events.where((at < lo) | (at >= max(lo, hi))), HOUR))


def select_ranks(events: DataFrame, ranges: list[tuple[int, int]], name: str = "ordinal",
                 directory: DataFrame | None = None, inner: tuple[int, int] | None = None) -> DataFrame:
    """Events at the positions of sorted, disjoint, closed ranges, with their position."""
    none = events.where(F.lit(False)).withColumn(name, F.lit(0).cast("bigint"))
    hours = _running(hours_of(events, directory, inner))
    held = _holding(hours, ranges)
    long = [b for b in held if b.n > LONG_HOUR]
    if long:
        minutes = _counts(events.where(_inside(long)), MINUTE)
        held = _holding(_running([b for b in hours if b not in long] + minutes), ranges)
    if not held:
        return none
    spark = events.sparkSession
    offsets = spark.createDataFrame([(b.start, b.before) for b in held], "_start bigint, _before bigint")
    start = bucket_start(HOUR)
    if long:
        start = F.when(bucket_start(HOUR).isin([b.start for b in long]), bucket_start(MINUTE)).otherwise(start)
    place = F.row_number().over(Window.partitionBy("_start").orderBy("event_ts", "event_key"))
    condition = F.lit(False)
    for lo, hi in ranges:
        condition = condition | F.col(name).between(lo, hi)
    numbered = events.where(_inside(held, "event_date" in events.columns)).withColumn("_start", start)
    return (numbered.join(offsets, "_start").withColumn(name, F.col("_before") + place - 1)
            .where(condition).drop("_start", "_before"))


def _inside(buckets: list[Bucket], by_day: bool = False) -> Column:
    """Time conditions that the scan can evaluate, and the days they lie in, for partitions."""
    spans: list[list[int]] = []
    for b in sorted(buckets):
        if spans and b.start <= spans[-1][1]:
            spans[-1][1] = b.start + b.width
        else:
            spans.append([b.start, b.start + b.width])
    if len(spans) > MOST_INTERVALS:
        spans = [[spans[0][0], spans[-1][1]]]
    out = F.lit(False)
    for lo, hi in spans:
        one = (F.col("event_ts") >= _instant(lo)) & (F.col("event_ts") < _instant(hi))
        if by_day:
            one = F.col("event_date").between(F.lit(_day(lo)), F.lit(_day(hi - 1))) & one
        out = out | one
    return out


def _instant(seconds: int) -> Column:
    return F.lit(datetime.fromtimestamp(seconds, timezone.utc))


def _day(seconds: int):
    return datetime.fromtimestamp(seconds, ZoneInfo(ZONE)).date()
