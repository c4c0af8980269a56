"""The ledger of an index: which files it holds, as they were when they were decoded."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventindex.functions.names import event_fields
from eventindex.sources.event_source import day_folders
from eventindex.sources.files import scan_files

LEDGER = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("event_date", T.DateType()),
])


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(f"{out}/ledger")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def listing(spark: SparkSession, root: str, extension: str = "h5", start: str = "", end: str = "") -> DataFrame:
    """Well-named files as ledger rows. With a first or last day (yyyy-mm-dd), only the day folders
    between them are listed; without, everything below the root is."""
    if not start and not end:
        files = scan_files(spark, root, extension)
    else:
        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(root)
        found = [path for day, path in day_folders(fs, base)
                 if (not start or str(day) >= start) and (not end or str(day) <= end)]
        if not found:
            return spark.createDataFrame([], LEDGER)
        prefix = root.rstrip("/")
        base = base.rstrip("/")
        files = scan_files(spark, [prefix + path.removeprefix(base) for path in found], extension)
    fields = event_fields(F.col("path"))
    return (files.where(fields["event_key"].isNotNull())
            .withColumn("event_date", fields["event_date"]).select(*LEDGER.names))
