"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. AQE is both the size check for broadcasts (a join side is broadcast
# only once its measured size is under the threshold) and the way out for hot keys (skewed
# partitions of sort-merge joins are split, at the price of a further shuffle where the split
# rows are grouped by the same key).
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the default timestamp type of Parquet files has no statistics, so no filter could skip
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "zstd",
}


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: they need not run in its
    folder or have it installed."""
    sc, folder = spark.sparkContext, Path(__file__).resolve().parent
    if sc.applicationId in _shipped or not folder.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="eventindex-")) / "eventindex.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(folder.rglob("*.py")):
            out.write(file, file.relative_to(folder.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on, and make it known to the Python workers."""
    ship_package(spark)
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="eventindex-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def task_count(spark: SparkSession, most: int | None = None) -> int:
    """Tasks for work that is dealt out by key and streamed in a task: some for each core, more
    where spark.sql.shuffle.partitions says so, and no more than there are keys."""
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return tasks if most is None else max(1, min(tasks, most))


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder, so retries and re-reads see the same rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
