"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's
documents.

1. quality classifier: documents predicted 0 go
2. exact deduplication: of equal texts the largest doc_id stays
3. n-gram Jaccard join: the smallest doc_id of every group of near copies stays
4. mixing: documents come as often as the mix of sources takes them
5. byte-level BPE: the ids of every document that comes out of the mix, and their bytes
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from eventindex.llm import bpe, exact_dedup, mixing, parity_join, quality_knn  # noqa: E402
from eventindex.llm.common import table  # noqa: E402
from eventindex.llm.registry import prepare  # noqa: E402
from eventindex.session import new_path  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model is fitted on the labelled documents of the stage's input."""
    model = quality_knn.fit(docs, table(prepare(spark), sf_dir, "labels"))
    return quality_knn.keep_good(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return parity_join.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.resample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256; a document taken twice comes twice."""
    import public_tokenizers

    prepare(spark)
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                  public_tokenizers.PATTERN))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near),
          ("mixing sources", mix), ("byte-level BPE", encode)]

# the first stage is a trained model, which SQL cannot express; tests hold every stage against a
# brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
