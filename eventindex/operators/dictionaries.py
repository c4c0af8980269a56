"""Dictionaries of names, comments and constants, and their search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from eventindex.operators.constants import constant_state, constants_of
from eventindex.operators.ordinals import with_ordinals


def distinct_names(leaf: DataFrame) -> DataFrame:
    return leaf.select("dataset_name").distinct()


def comment_dictionary(rows: DataFrame, order: tuple[str, ...] = ("event_ts", "event_key", "seq")
                       ) -> DataFrame:
    """Comment to dataset name; the last writer wins, empty comments are skipped."""
    return (rows.where(F.col("comment") != "")
            .groupBy("comment")
            .agg(F.max_by("dataset_name", F.struct(*order, "dataset_name"))
                 .alias("dataset_name")))


def constant_values(leaf: DataFrame, min_rows: int = 1, scalars_only: bool = False) -> DataFrame:
    """Datasets with one and the same value wherever they occur, with the group, shape and
    dtype of their first row. A missing value counts as the empty text."""
    return constants_of(constant_state(leaf, scalars_only), min_rows)


def number_constants(constants: DataFrame) -> DataFrame:
    """Add `ref`, the 1-based line in the stored dictionary, whose first line is the header."""
    return with_ordinals(constants, ("dataset_name",), "ref", first=2)


def encode_constants(leaf: DataFrame, constants: DataFrame) -> DataFrame:
    """Replace a value by the reference of its constant. Joined on name and value, so a value
    that has changed since the dictionary was built stays in the row."""
    # NULL only marks "no single value"; the dictionary holds it as empty text
    key = F.coalesce(leaf["value"], F.lit(""))
    refs = constants.select("ref", F.col("dataset_name").alias("_name"),
                            F.col("value").alias("_value"))
    joined = leaf.join(refs, (leaf["dataset_name"] == refs["_name"]) & (key == refs["_value"]),
                       "left")
    return (joined.withColumn("value", F.when(F.col("ref").isNull(), F.col("value")))
            .drop("_name", "_value"))


def decode_constants(encoded: DataFrame, constants: DataFrame) -> DataFrame:
    """Inverse of encode_constants; datasets without a single value come back as NULL."""
    values = constants.select(F.col("ref").alias("_key"),
                              F.nullif("value", F.lit("")).alias("_value"))
    # Rows without a reference are most of the table. Left NULL, they would all be shuffled to
    # one partition; spread them over keys that no constant has.
    plain = [f.name for f in encoded.schema.fields
             if isinstance(f.dataType, (T.StringType, T.NumericType))]
    spread = -1 - F.pmod(F.xxhash64(*plain), F.lit(1 << 20))
    return (encoded.withColumn("_key", F.coalesce("ref", spread))
            .join(values, "_key", "left")
            .withColumn("value", F.coalesce("value", "_value"))
            .drop("_key", "_value", "ref"))


def merge_comments(old: DataFrame, new: DataFrame) -> DataFrame:
    """New comments override old ones."""
    both = (old.withColumn("_gen", F.lit(0))
            .unionByName(new.select(*old.columns).withColumn("_gen", F.lit(1))))
    return (both.groupBy("comment")
            .agg(F.max_by("dataset_name", F.struct("_gen", "dataset_name"))
                 .alias("dataset_name")))


def merge_names(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.select("dataset_name").union(new.select("dataset_name")).distinct()


def keyword_condition(keywords: str, column: str = "dataset_name") -> Column:
    """Every space-separated keyword is part of the name, in any case; nothing matches ""."""
    if keywords == "":
        return F.lit(False)
    out = F.lit(True)
    for word in keywords.lower().split(" "):
        out = out & F.lower(column).contains(word)
    return out


def keyword_search(names: DataFrame, keywords: str) -> DataFrame:
    return names.where(keyword_condition(keywords))


def comment_search(comments: DataFrame, phrase: str) -> DataFrame:
    """Datasets whose comment contains the whole phrase, in any case; nothing matches ""."""
    hit = F.lower("comment").contains(phrase.lower()) if phrase else F.lit(False)
    return comments.where(hit).select("dataset_name")


def matched_names(names: DataFrame, comments: DataFrame, keywords: str, phrase: str) -> DataFrame:
    """Names found by keyword or by comment, each once."""
    return (keyword_search(names, keywords).select("dataset_name")
            .union(comment_search(comments, phrase)).distinct())
