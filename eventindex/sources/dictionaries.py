"""Stored dictionaries, and the mixed records an indexing job leaves behind."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventindex.functions.values import text_to_attrs
from eventindex.schema import COMMENTS, CONSTANTS, DATASET_NAMES


class Dictionaries(NamedTuple):
    names: DataFrame
    comments: DataFrame
    constants: DataFrame


_PARTS = {"names": DATASET_NAMES, "comments": COMMENTS, "constants": CONSTANTS}


def write_dictionaries(dictionaries: Dictionaries, path: str) -> None:
    for name, schema in _PARTS.items():
        part = getattr(dictionaries, name).select(*schema.names)
        part.write.mode("overwrite").parquet(f"{path}/{name}")


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_dictionaries(spark: SparkSession, path: str) -> Dictionaries:
    """The three dictionaries; one that is missing is empty."""
    return Dictionaries(*(_read_or_empty(spark, f"{path}/{name}", schema)
                          for name, schema in _PARTS.items()))


class MixedRecords(NamedTuple):
    comments: DataFrame
    names: DataFrame
    files: DataFrame
    rejects: DataFrame   # what could not be read: reason and text


def split_mixed(lines: DataFrame, column: str = "value") -> MixedRecords:
    """Split job output by the kind of its keys. Every line is a dictionary: keys with
    "comment" hold `comment,dataset` lines (other lines are rejected), keys with "dataset" a
    comma-separated name list, all other keys are paths holding the text of an index file. Lines
    that are no dictionary are rejected."""
    read = lines.select(F.col(column).alias("text"), text_to_attrs(F.col(column)).alias("entries"))
    broken = (F.size("entries") == 0) & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"^\s*(\{\s*\})?\s*$")
    pairs = read.select(F.explode("entries").alias("k", "v"))
    is_comment, is_names = F.contains("k", F.lit("comment")), F.contains("k", F.lit("dataset"))
    fields = F.split("line", ",")
    comment_lines = pairs.where(is_comment).select(F.explode(F.split("v", r"\r?\n")).alias("line"))
    comments = (comment_lines.where(F.size(fields) == 2)
                .select(F.element_at(fields, 1).alias("comment"),
                        F.element_at(fields, 2).alias("dataset_name")))
    names = (pairs.where(~is_comment & is_names)
             .select(F.explode(F.split("v", ",")).alias("dataset_name")))
    files = (pairs.where(~is_comment & ~is_names)
             .select(F.col("k").alias("path"), F.col("v").alias("content")))
    rejects = (read.where(broken).select(F.lit("no dictionary").alias("reason"), "text")
               .unionByName(comment_lines.where((F.size(fields) != 2) & (F.col("line") != "")).select(
                   F.lit("no comment and name").alias("reason"), F.col("line").alias("text"))))
    return MixedRecords(comments, names, files, rejects)


def file_lines(files: DataFrame) -> DataFrame:
    """Texts of index files (path, content) as lines for `records.number_records`; each text is one
    piece, so that it may be put together from many lines of a job's output."""
    return files.select("path", F.lit(0).cast("bigint").alias("piece"),
                        F.posexplode(F.split("content", "\n")).alias("line", "value"))
