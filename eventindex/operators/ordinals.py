"""Selection by position in a sorted listing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventindex.operators.ranks import select_ranks
from eventindex.session import materialise

EVENT_ORDER = ("event_ts", "event_key")

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition below this bit


def parse_ordinals(spec: str) -> list[tuple[int, int]]:
    """`"7"`, `"1,3,9"`, `"0-50"`, `"1,5-9"` to sorted, disjoint closed ranges."""
    ranges = []
    for part in spec.split(","):
        found = re.fullmatch(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?", part)
        if not found:
            raise ValueError(f"no ordinal or range: {part!r}")
        lo = int(found[1])
        hi = int(found[2]) if found[2] else lo
        if lo <= hi:
            ranges.append((lo, hi))
    merged: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if merged and lo <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def in_ranges(position: Column, ranges: list[tuple[int, int]]) -> Column:
    out = F.lit(False)
    for lo, hi in ranges:
        out = out | position.between(lo, hi)
    return out


def with_ordinals(df: DataFrame, order_by=EVENT_ORDER, name: str = "ordinal",
                  first: int = 0) -> DataFrame:
    """Number all rows in sorted order without bringing them into one task.

    The range-partitioned sort balances on the full sort key, so a hot day does not end in one
    partition. The sorted rows are materialised once: the per-partition counts and the rows
    must come from the same partitioning.
    """
    row = F.monotonically_increasing_id()
    listed = materialise(df.orderBy(*order_by).withColumn("_row", row))
    part = F.shiftright("_row", _ROW_BITS)
    counts = listed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row per sort partition, so the window and the broadcast are bounded by that number
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    position = F.col("_off") + F.col("_row").bitwiseAND((1 << _ROW_BITS) - 1) + F.lit(first)
    return (listed.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(name, position)
            .drop("_part", "_off", "_row"))


def select_ordinals(df: DataFrame, spec: str, order_by=EVENT_ORDER, name: str = "ordinal",
                    directory: DataFrame | None = None, inner: tuple[int, int] | None = None) -> DataFrame:
    """Rows at the listed positions (both ends included); positions past the end match nothing.
    Events in their usual order are found through the rank directory, the stored one if it is given;
    other listings are numbered."""
    ranges = parse_ordinals(spec)
    if tuple(order_by) == EVENT_ORDER and ranges:
        return select_ranks(df, ranges, name, directory, inner)
    if not ranges:
        return df.where(F.lit(False)).withColumn(name, F.lit(0).cast("bigint"))
    return with_ordinals(df, order_by, name).where(in_ranges(F.col(name), ranges))


def slice_rows(df: DataFrame, start: int, stop: int, order_by=EVENT_ORDER) -> DataFrame:
    """Rows start (included) to stop (excluded) of the sorted listing."""
    return select_ordinals(df, f"{start}-{stop - 1}", order_by).drop("ordinal")
