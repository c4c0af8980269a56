import pytest

SF = "/root/testdata/sf0.001"
# nulls, empty and blank texts, ties, repeated rows, and columns named like the operators' own
ODD = [(1, "A b c d e f. The end of it all.", "s1"), (2, None, None), (None, "x y z", "s1"), (3, "", "s2"),
       (3, "", "s2"), (4, " \n\t ", "s2"), (5, "a B c d e f. The end of it all.", "s1"),
       (6, "A b c d e f. The end of it all.", None), (7, "x y z", "s2"),
       (8, "one two. " * 3_000, "s3"), (9, "q" * 5_000, "s3")]
SCHEMA = "doc_id bigint, text string, source string"


@pytest.fixture
def odd(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, SCHEMA)
    for c in ("digest", "salt", "n", "key", "component", "uid", "size", "block", "score", "words"):
        rows = rows.withColumn(c, F.lit("clash"))
    return rows


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
