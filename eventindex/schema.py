"""Fixed schemas of the stored tables."""

from pyspark.sql import types as T

STR, LONG, DBL = T.StringType(), T.LongType(), T.DoubleType()

EVENTS = T.StructType([
    T.StructField("event_key", STR),
    T.StructField("event_ns", LONG),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("n1", LONG),
    T.StructField("n2", LONG),
    T.StructField("path", STR),
    T.StructField("event_date", T.DateType()),
])

# One row per dataset of an event. `seq` is the walk order inside the event, so "first match"
# has one answer; `value` is NULL unless the dataset holds exactly one element.
LEAF = T.StructType([
    T.StructField("event_key", STR),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("dataset_name", STR),
    T.StructField("group_name", STR),
    T.StructField("attrs", T.MapType(STR, STR)),
    T.StructField("comment", STR),
    T.StructField("acq_stamp", STR),
    T.StructField("exception", STR),
    T.StructField("value", STR),
    T.StructField("value_num", DBL),
    T.StructField("shape", T.ArrayType(T.IntegerType())),
    T.StructField("size", LONG),
    T.StructField("dtype", STR),
    T.StructField("seq", LONG),
    T.StructField("event_date", T.DateType()),
])

PAYLOAD = T.StructType([
    T.StructField("event_key", STR),
    T.StructField("dataset_name", STR),
    T.StructField("data", T.ArrayType(DBL)),
    T.StructField("event_date", T.DateType()),
])

DATASET_NAMES = T.StructType([T.StructField("dataset_name", STR)])

COMMENTS = T.StructType([
    T.StructField("comment", STR),
    T.StructField("dataset_name", STR),
])

CONSTANTS = T.StructType([
    T.StructField("ref", LONG),
    T.StructField("dataset_name", STR),
    T.StructField("group_name", STR),
    T.StructField("value", STR),
    T.StructField("shape", T.ArrayType(T.IntegerType())),
    T.StructField("dtype", STR),
])
