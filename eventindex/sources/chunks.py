"""Array payloads kept as they are, in chunks of rows.

An array is stored with its element type and shape, as the bytes of its elements, cut into chunks of
whole rows (the first dimension). Nothing is converted: integers keep all digits, pixels their width,
and text and mixed values are kept as JSON. A read of some rows of a frame is a range filter on the
row numbers of the chunks, which the scan evaluates; no other chunk is read, and nothing is shuffled.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventindex.functions.names import event_fields
from eventindex.sources.containers import Decoder, Entry

CHUNK_BYTES = 1 << 20
_ROWS, _BYTES = 5_000, 8 << 20
JSON = "json"   # element type of all values that have no numeric one

CHUNKS = T.StructType([
    T.StructField("event_key", T.StringType()),
    T.StructField("dataset_name", T.StringType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("shape", T.ArrayType(T.LongType())),
    T.StructField("chunk", T.IntegerType()),
    T.StructField("first_row", T.LongType()),
    T.StructField("last_row", T.LongType()),
    T.StructField("data", T.BinaryType()),
    T.StructField("event_date", T.DateType()),
])
_PACKED = ("path string, dataset_name string, dtype string, shape array<bigint>, chunk int, "
           "first_row bigint, last_row bigint, data binary")
_COLUMNS = ["path", "dataset_name", "dtype", "shape", "chunk", "first_row", "last_row", "data"]

# element types of the results, and what they are in Spark
KINDS = {"bigint": np.int64, "double": np.float64, "string": None}


def typed(data) -> np.ndarray | list:
    """Values as an array of their own type, where all have the same numeric one, else a list."""
    if isinstance(data, np.ndarray):
        if data.dtype.kind in "iufb":
            return data.ravel()
        return [x.decode("utf-8", "backslashreplace") if isinstance(x, bytes) else x for x in data.ravel().tolist()]
    data = list(data)
    kinds = {type(x) for x in data}
    if kinds == {float}:
        return np.array(data, "<f8")
    if kinds == {bool}:
        return np.array(data, "|b1")
    if kinds == {int} and -2**63 <= min(data) and max(data) < 2**63:
        return np.array(data, "<i8")
    return data


def pack(entry: Entry, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple]:
    """(dtype, shape, chunk, first_row, last_row, bytes) of the chunks of one dataset; an empty array
    has a single one without rows."""
    values = typed(entry.data)
    shape = [int(x) for x in entry.shape] or [len(values)]
    width = max(1, math.prod(shape[1:]))
    if isinstance(values, np.ndarray):
        values = values.astype(values.dtype.newbyteorder("<"), copy=False)
        dtype, row_bytes = values.dtype.str, width * values.dtype.itemsize
    else:
        dtype, row_bytes = JSON, max(1, sum(len(str(x)) for x in values) * width // max(1, len(values)))
    step = max(1, chunk_bytes // row_bytes)
    for chunk, first in enumerate(range(0, max(1, shape[0]), step)):
        last = min(first + step, shape[0])
        part = values[first * width:last * width]
        raw = part.tobytes() if isinstance(part, np.ndarray) else json.dumps(part).encode()
        yield dtype, shape, chunk, first, last - 1, raw


def unpack(dtype: str, raw: bytes) -> np.ndarray | list:
    return json.loads(raw) if dtype == JSON else np.frombuffer(raw, dtype)


def chunk_files(files: DataFrame, decoder: Decoder, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of all arrays of container files (`path`, `content`). Files that cannot be decoded and
    faults are reported by `decode_files`; here they have no rows."""
    def chunks_of(path: str, content: bytes) -> list[tuple]:
        try:
            return [(path, entry.dataset_name, *part) for entry in decoder(content, True)
                    if isinstance(entry, Entry) and entry.data is not None for part in pack(entry, chunk_bytes)]
        except (ImportError, MemoryError):  # concerns the job, not this file
            raise
        except Exception:
            return []

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for path, content in zip(batch["path"], batch["content"]):
                rows += chunks_of(path, bytes(content))
                if len(rows) >= _ROWS or sum(len(r[-1]) for r in rows[-64:]) >= _BYTES:
                    yield pd.DataFrame(rows, columns=_COLUMNS, dtype=object)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=_COLUMNS, dtype=object)

    packed = files.select("path", "content").mapInPandas(run, _PACKED)
    fields = event_fields(F.col("path"))
    return (packed.withColumns({c: fields[c] for c in ("event_key", "event_date")})
            .where("event_key IS NOT NULL").select(*CHUNKS.names))


def write_chunks(chunks: DataFrame, path: str) -> None:
    """By day, the chunks of a dataset together and small row groups, so that filters on dataset and
    rows skip most of a file."""
    (chunks.sortWithinPartitions("event_date", "dataset_name", "event_key", "chunk")
     .write.mode("overwrite").partitionBy("event_date").option("partitionOverwriteMode", "dynamic")
     .option("parquet.block.size", 32 << 20).option("parquet.page.size.row.check.min", 4)
     .parquet(path))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNKS).parquet(path)


def in_rows(first: int, last: int) -> Column:
    """Chunks that hold one of the rows, as plain comparisons that a scan can evaluate."""
    return (F.col("first_row") <= last) & (F.col("last_row") >= first)


def frame_rows(chunks: DataFrame, first: int = 0, last: int | None = None, columns: tuple[int, int] | None = None,
               kind: str = "double") -> DataFrame:
    """Rows `first` to `last` (included; None: to the end) of every array, one row each: event_key,
    dataset_name, event_date, row, values. `columns` cuts each row to a range (both included).
    `kind` is the element type of the result; a value that it cannot hold without loss is an error
    (numbers as "string" are written with all their digits)."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    wanted = chunks.where(in_rows(first, last)) if last is not None else chunks.where(F.col("last_row") >= first)
    end = last

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("event_key", pa.string()), ("dataset_name", pa.string()), ("event_date", pa.date32()),
                            ("row", pa.int64()), ("values", pa.list_({
                                "bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}[kind]))])
        for batch in batches:
            out, size = [], 0
            for r in batch.to_pylist():
                values = convert(unpack(r["dtype"], r["data"]), kind)
                width = max(1, math.prod(r["shape"][1:]))
                lo, hi = max(first, r["first_row"]), r["last_row"] if end is None else min(end, r["last_row"])
                left, right = columns or (0, width - 1)
                for row in range(lo, hi + 1):
                    at = (row - r["first_row"]) * width
                    out.append((r["event_key"], r["dataset_name"], r["event_date"], row,
                                values[at:at + width][left:right + 1]))
                size += len(values)
                if size >= _BYTES // 8:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    needed = ["event_key", "dataset_name", "event_date", "dtype", "shape", "first_row", "last_row", "data"]
    return wanted.select(*needed).mapInArrow(
        run, f"event_key string, dataset_name string, event_date date, row bigint, values array<{kind}>")


def convert(values: np.ndarray | list, kind: str) -> np.ndarray | list:
    """Elements as the kind asked for; ValueError where one would change."""
    if kind == "string":
        listed = values.tolist() if isinstance(values, np.ndarray) else values
        return [None if x is None else x if isinstance(x, str) else json.dumps(x) for x in listed]
    before = np.asarray(values)
    if before.dtype.kind not in "iufb":
        raise ValueError("values that are no numbers can be read as strings only")
    after = before.astype(KINDS[kind])
    if after.dtype != before.dtype:
        same = np.array_equal(after.astype(before.dtype), before, equal_nan=before.dtype.kind == "f")
        # large integers may survive the way there and back although they differ in between
        if before.dtype.kind in "iu":
            same &= not (np.abs(after) >= 2.0 ** 53).any() if kind == "double" else not (after < 0).any() or before.dtype.kind == "i"
        if not same:
            raise ValueError(f"some values of type {before.dtype} cannot be read as {kind} without loss")
    return after
