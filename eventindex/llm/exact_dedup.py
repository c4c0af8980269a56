"""Exact duplicates by skew-safe combining.

Texts are grouped in three steps, each of which has the full text among its grouping keys, so
equal digests alone never join two texts:

1. every map task combines its own rows (the partial side of the first aggregation),
2. salted groups combine the tasks' results: a text that fills a third of the table meets in
   `SALTS` tasks of one short row per map task, not in one,
3. the winners of the salts are combined.

The result goes back to the rows by digest alone, so texts are shuffled for grouping only. A digest
found with two different texts (none is known for SHA-256) would be ambiguous there: it stops the
job with an error.

Defined results: null text counts as empty, all empty texts are one group; a null id is smaller
than any other, and a group of null ids only keeps one of them; rows that repeat both id and text
count in `group_size` and are returned once; an empty table gives an empty result. Columns other
than id and text play no part in the choice and may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from eventindex.llm.common import text_or_empty

SALTS = 32


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text: digest, text, keep_id (largest id), group_size."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       text_or_empty(text_col).alias("text"))
    local = rows.select("doc_id", "text", F.sha2("text", 256).alias("digest"),
                        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
    salted = (local.groupBy("digest", "salt", "text")
              .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n")))
    return (salted.groupBy("digest", "text")
            .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")))


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = groups(docs, id_col, text_col)
    # the verdict per digest: fixed-width buffers, texts are left behind here
    verdicts = (found.groupBy("digest")
                .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
                     F.count("*").alias("texts")))
    members = (docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                           F.sha2(text_or_empty(text_col), 256).alias("digest"))
               .groupBy("digest", "doc_id").agg(F.count("*").alias("copies")))
    size = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
        F.raise_error(F.concat(F.lit("two texts share the digest "), "digest")).cast("bigint"))
    return members.join(verdicts, "digest").select(
        "doc_id", "keep_id", size.alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; one row for repeated ids and texts."""
    def key(doc_id, digest):
        return F.concat_ws(":", digest, F.coalesce(F.col(doc_id).cast("string"), F.lit("-")))

    # the size is asked for, so that two texts under one digest stop this job as well
    kept = (classify(docs, id_col, text_col).filter("kept AND group_size > 0")
            .select(key("doc_id", F.col("text_sha256")).alias("_key")))
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("bigint").alias("_id"),
                       F.sha2(text_or_empty(text_col), 256).alias("_digest")).select(
        "_row", key("_id", F.col("_digest")).alias("_key"))
    # a rank limit of one is applied before the shuffle as well, so repeated rows cannot pile up; the
    # join uses the same key and needs no further shuffle of the rows
    first = Window.partitionBy("_key").orderBy(F.xxhash64("_row"))
    return (rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
            .join(kept, "_key", "left_semi").select("_row.*"))
