"""The stored leaf index, as day-partitioned Parquet or CSV, and per-event CSV trees."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventindex.functions.names import event_fields
from eventindex.functions.values import (attr_triple, attrs_to_text, parse_shape, shape_size, shape_text,
                                         text_to_attrs, to_number)
from eventindex.schema import LEAF
from eventindex.sources.records import parse_records, quoted_records

# Column headers of a per-event CSV file.
CSV_FULL = ["DatasetName", "GroupName", "Dataset Attributes", "DatasetValue", "Shape", "Datatype"]
CSV_CLUSTER = ["DatasetName", "GroupName", "acqStamp", "exception", "DatasetValue", "Shape", "Datatype"]
CSV_OPTIMIZED = ["DatasetName", "GroupName", "DatasetValue", "Shape", "Datatype"]

# Values may hold quotes, line breaks and blanks; NULL and the empty text are different things.
CSV_OPTIONS = {"nullValue": "\\N", "escape": '"', "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

SORT = ("event_date", "dataset_name", "event_key", "seq")


def _csv_type(field: T.StructField) -> T.StructField:
    nested = isinstance(field.dataType, (T.MapType, T.ArrayType))
    return T.StructField(field.name, T.StringType() if nested else field.dataType)


CSV_LEAF = T.StructType([_csv_type(f) for f in LEAF.fields])


def write_leaf(leaf: DataFrame, path: str, layout: str = "parquet", attrs: bool = True) -> None:
    """Write whole days, replacing those present. Range partitioning on (day, dataset, event,
    position) splits a hot day, dataset or event over several tasks, and leaves every file with
    a narrow range of dataset names, so name filters skip row groups. Columns the layout lacks are NULL when
    read back; `attrs=False` leaves the attributes out."""
    # no number of partitions: ranges start from spark.sql.shuffle.partitions, and small neighbours
    # are merged by their measured bytes
    keys = [c for c in SORT if c in leaf.columns]
    out = leaf.repartitionByRange(*keys).sortWithinPartitions(*keys)
    if layout == "csv":
        if "attrs" in out.columns:
            out = out.withColumn("attrs", attrs_to_text(F.col("attrs")))
        if "shape" in out.columns:
            out = out.withColumn("shape", shape_text(F.col("shape")))
        have = [F.col(c) if c in out.columns else F.lit(None).cast(CSV_LEAF[c].dataType).alias(c)
                for c in CSV_LEAF.names]
        out = out.select(*have)
        if not attrs:
            out = out.withColumn("attrs", F.lit(None).cast("string"))
    elif not attrs:
        out = out.drop("attrs")
    (out.write.mode("overwrite").partitionBy("event_date")
     .option("partitionOverwriteMode", "dynamic").option("header", "true")
     .options(**CSV_OPTIONS)
     .format(layout).save(path))


def read_leaf(spark: SparkSession, path: str, layout: str = "parquet") -> DataFrame:
    if layout == "parquet":
        return spark.read.schema(LEAF).parquet(path)
    rows = spark.read.schema(CSV_LEAF).options(**CSV_OPTIONS).option("header", "true").csv(path)
    return (rows.withColumn("attrs", F.when(F.col("attrs").isNotNull(),
                                            text_to_attrs(F.col("attrs"))))
            .withColumn("shape", parse_shape(F.col("shape")))
            .select(*LEAF.names))


def _read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_ranks(spark: SparkSession, out: str) -> DataFrame | None:
    """The stored rank directory of an index; None for an index without one."""
    return _read_if_there(spark, f"{out}/ranks", "start bigint, n bigint, event_date date")


def read_groups(spark: SparkSession, out: str) -> DataFrame | None:
    """Dataset names with their groups; None for an index that does not store them."""
    return _read_if_there(spark, f"{out}/groups", "dataset_name string, group_name string")


LAYOUTS = {"full": CSV_FULL, "optimized": CSV_OPTIMIZED, "cluster": CSV_CLUSTER}
CSV_QUOTED = {"escape": '"', "mode": "PERMISSIVE"}


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_central(spark: SparkSession, path: str) -> DataFrame:
    """The central file of constants, as a dictionary of constants: `ref` counts the lines of the
    file as records, the header being the first."""
    rows = parse_records(quoted_records(spark, path), _texts(CSV_OPTIMIZED), CSV_QUOTED)
    return rows.select((F.col("record") + 1).alias("ref"), F.col("DatasetName").alias("dataset_name"),
                       F.col("GroupName").alias("group_name"), F.coalesce("DatasetValue", F.lit("")).alias("value"),
                       parse_shape(F.coalesce("Shape", F.lit(""))).alias("shape"), F.col("Datatype").alias("dtype"))


def read_event_csvs(spark: SparkSession, root: str, layout: str = "full", central: str | None = None) -> DataFrame:
    """A tree of one CSV file per event in year/month/day folders, as leaf rows. The file name
    gives event and time, the record number the place in walk order.

    Layouts: "full", "optimized" (without attributes) and "cluster" (without a header, with stamp and
    exception). Comment, stamp and exception come from the attributes where a layout has them. A row
    without a shape refers to a constant by its number in the `central` file, whose value, shape and
    type it gets; without that file, or for a number it lacks, it has no value."""
    records = quoted_records(spark, root).where("NOT contains(path, '/Central/')")
    rows = parse_records(records, _texts(LAYOUTS[layout]), CSV_QUOTED, header=layout != "cluster")
    return csv_leaf(rows, layout, read_central(spark, central) if central else None)


def csv_leaf(rows: DataFrame, layout: str, constants: DataFrame | None = None) -> DataFrame:
    """Parsed records (path, record, and the columns of a layout) as leaf rows."""
    none = F.lit(None).cast("string")
    attrs_text = F.col("`Dataset Attributes`") if layout == "full" else none
    # a reference has no shape; its number stands in the column after the group
    refers = F.coalesce("Shape", F.lit("")) == ""
    number = {"full": attrs_text, "optimized": F.col("DatasetValue"), "cluster": none}[layout]
    rows = rows.withColumns({
        **event_fields(F.col("path")), "ref": F.when(refers, number.try_cast("bigint")),
        "attrs": text_to_attrs(F.coalesce(F.when(~refers, attrs_text), F.lit("")))})
    value, shape, dtype = F.col("DatasetValue"), parse_shape(F.coalesce("Shape", F.lit(""))), F.col("Datatype")
    rows = rows.select(
        "event_key", "event_ts", "event_date", F.col("DatasetName").alias("dataset_name"),
        F.col("GroupName").alias("group_name"), "attrs", "ref", F.col("record").alias("seq"),
        F.when(F.col("ref").isNull(), value).alias("value"), F.when(~refers, shape).alias("shape"),
        F.when(~refers, dtype).alias("dtype"),
        *([F.col("acqStamp").alias("acq_stamp"), F.col("exception")] if layout == "cluster" else [])
    ).where("event_key IS NOT NULL")
    if constants is not None:
        # rows that refer to nothing, most of them, are spread over keys that no constant has
        spread = -1 - F.pmod(F.xxhash64("event_key", "seq"), F.lit(1 << 20))
        known = constants.select(F.col("ref").alias("_ref"), F.col("dataset_name").alias("_name"), *[
            F.col(c).alias(f"_{c}") for c in ("value", "shape", "dtype")])
        rows = (rows.withColumn("_key", F.coalesce("ref", spread))
                .join(known, (F.col("_key") == F.col("_ref")) & (F.col("dataset_name") == F.col("_name")), "left")
                .withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in ("value", "shape", "dtype")}))
    size = F.when(F.col("shape").isNotNull(), shape_size(F.col("shape")))
    value = F.when(F.coalesce(size, F.lit(1)) == 1, F.col("value"))
    triple = ({"comment": F.lit(""), "acq_stamp": F.coalesce("acq_stamp", F.lit("nan")),
               "exception": F.coalesce("exception", F.lit("False"))} if layout == "cluster"
              else attr_triple(F.create_map().cast("map<string,string>"), F.col("attrs")))
    return rows.withColumns({"size": size, "value": value, "value_num": to_number(value), **triple}).select(
        "event_key", "event_ts", "dataset_name", "group_name", "attrs", "comment", "acq_stamp", "exception",
        "value", "value_num", "shape", "size", "dtype", "seq", "event_date")
