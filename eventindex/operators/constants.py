"""Which datasets never change their value: a state that is kept per day and merged without leaves.

A state row tells of one dataset how many rows it has, the least and greatest of two independent
64-bit hashes of its value, and when it occurs first. These are fixed-width, so leaf rows are
aggregated by hash, and combined before the shuffle. Equal extremes of both hashes mean one value;
its text, group, shape and type are fetched for such datasets only, from their first row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

STATE = T.StructType([
    T.StructField("dataset_name", T.StringType()),
    T.StructField("n", T.LongType()),
    *[T.StructField(f"{end}_{h}", T.LongType()) for h in ("hash", "check") for end in ("min", "max")],
    T.StructField("first_ts", T.TimestampType()),
    T.StructField("first_key", T.StringType()),
    T.StructField("first_seq", T.LongType()),
    T.StructField("group_name", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("shape", T.ArrayType(T.IntegerType())),
    T.StructField("dtype", T.StringType()),
    T.StructField("event_date", T.DateType()),
])

_HASHES = ("hash", "check")
_FIRST = ("first_ts", "first_key", "first_seq")


def _is_constant():
    return (F.col("min_hash") == F.col("max_hash")) & (F.col("min_check") == F.col("max_check"))


def constant_state(leaf: DataFrame, scalars_only: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """State of the datasets of leaf rows, for each value of the `by` columns apart. A missing value
    counts as the empty text; the first row is the one of least (event_ts, event_key, seq)."""
    rows = leaf.where("size = 1") if scalars_only else leaf
    value, keys = F.coalesce("value", F.lit("")), [*by, "dataset_name"]
    hashed = rows.select(*keys, "event_ts", F.xxhash64(value).alias("hash"),
                         F.xxhash64(F.lit("check"), value).alias("check"))
    extremes = [agg(h).alias(f"{end}_{h}") for h in _HASHES for end, agg in (("min", F.min), ("max", F.max))]
    counted = hashed.groupBy(*keys).agg(F.count("*").alias("n"), *extremes, F.min("event_ts").alias("first_ts"))
    # the key is hidden by an expression that changes nothing, so that both sides are fresh for AQE
    sought = counted.where(_is_constant()).select(
        *[F.col(k).alias(f"_{k}") for k in by], F.concat("dataset_name", F.lit("")).alias("_name"),
        F.col("first_ts").alias("_ts"))
    same = (F.col("dataset_name") == F.col("_name")) & F.col("event_ts").eqNullSafe(F.col("_ts"))
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    first = Window.partitionBy(*keys).orderBy("event_key", "seq")
    firsts = (rows.join(sought, same, "left_semi")
              .select(*keys, "event_key", "seq", "group_name", value.alias("value"), "shape", "dtype")
              .withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
              .withColumnsRenamed({"event_key": "first_key", "seq": "first_seq"}))
    renamed = firsts.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return counted.join(renamed, on, "left").drop(*[f"_{k}" for k in keys])


def merge_states(states: DataFrame) -> DataFrame:
    """One state row per dataset from rows of several days or indexes. A dataset that varies in one
    of them varies in all; of one that does not, the earliest first row stays."""
    whole = Window.partitionBy("dataset_name")
    first = whole.orderBy(*[F.col(c).asc_nulls_first() for c in _FIRST])
    extremes = {f"{end}_{h}": agg(f"{end}_{h}").over(whole)
                for h in _HASHES for end, agg in (("min", F.min), ("max", F.max))}
    merged = states.withColumns({"_n": F.row_number().over(first), "n": F.sum("n").over(whole), **extremes})
    return merged.where("_n = 1").drop("_n")


def constants_of(state: DataFrame, min_rows: int = 1) -> DataFrame:
    """The datasets with one and the same value wherever they occur."""
    return (state.where(_is_constant() & (F.col("n") >= min_rows))
            .select("dataset_name", "group_name", "value", "shape", "dtype"))
