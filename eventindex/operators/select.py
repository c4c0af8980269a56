"""Filters and per-event selection on leaf rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventindex.functions.times import range_condition

EVENT = ("event_key", "event_ts", "event_date")


def time_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows from start to end (local wall clock, both included)."""
    return df.where(range_condition(start, end))


def name_condition(names: str | list[str], match: str = "equals",
                   column: str = "dataset_name") -> Column:
    """Match one of the names: `equals`, literal `contains`, or `regex` containment."""
    names = [names] if isinstance(names, str) else list(names)
    col = F.col(column)
    if match == "equals":
        return col.isin(*names)
    if match not in ("contains", "regex"):
        raise ValueError(f"unknown match mode {match!r}")
    out = F.lit(False)
    for n in names:
        out = out | (col.contains(n) if match == "contains" else col.rlike(n))
    return out


def first_of(value: Column, condition: Column, order: Column | None = None) -> Column:
    """Value of the first row in walk order that meets the condition. Both arguments are
    guarded, as the value itself may be NULL on the first row."""
    order = F.col("seq") if order is None else order
    return F.min_by(F.when(condition, value), F.when(condition, order))


def first_values(leaf: DataFrame, value: str = "value") -> DataFrame:
    """First value per event and dataset."""
    return (leaf.groupBy("event_key", "dataset_name")
            .agg(F.min_by(value, "seq").alias(value)))


def pivot_columns(leaf: DataFrame, names: dict[str, str], value: str = "value",
                  match: str = "equals", extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per event, one column per chosen dataset (`names`: output column to dataset);
    NULL where an event lacks it. Events with none of them are dropped, unless `extra`
    aggregates are given, whose caller decides."""
    chosen = name_condition(list(names.values()), match)
    aggregates = [first_of(F.col(value), name_condition(n, match)).alias(out)
                  for out, n in names.items()]
    if extra is None:
        return leaf.where(chosen).groupBy(*EVENT).agg(*aggregates)
    more = [agg.alias(name) for name, agg in extra.items()]
    return leaf.groupBy(*EVENT).agg(*aggregates, F.count_if(chosen).alias("_found"), *more)


def fresh_keys(keys: DataFrame, key: str = "event_key") -> DataFrame:
    """Key rows made by an aggregation, for a join against many rows per key. Their grouping is
    hidden by an expression that changes nothing, so the join shuffles both sides: only between
    two fresh shuffles can AQE split a hot key. The key rows are narrow, so theirs is cheap."""
    return keys.withColumn(key, F.concat(key, F.lit("")))


def count_per_day(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date").agg(F.count("*").alias("n"))
