"""Container files to leaf rows and payloads.

Spark lists, splits and shuffles the files; a decoder turns the bytes of one file into
`Entry` tuples. Everything after that (names, times, value rules, attributes) is columns.
"""

from __future__ import annotations

import inspect
import io
import json
import re
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventindex.functions.names import event_fields
from eventindex.functions.values import attr_triple, shape_size, to_number, value_by_dtype
from eventindex.schema import LEAF, PAYLOAD
from eventindex.session import task_count
from eventindex.sources.files import FileReader, opened_file


class Entry(NamedTuple):
    dataset_name: str
    group_name: str
    group_attrs: dict[str, str]
    attrs: dict[str, str]
    text: str | None          # text of a one-element dataset
    shape: list[int]
    dtype: str
    data: Any                 # flat values of a larger dataset, as they are, when asked for


class Fault(NamedTuple):
    """A dataset that cannot be read; the others of its container are kept."""
    dataset_name: str
    error: str


# Bytes, whether to read arrays, and (optionally) which dataset names to read. Entries come in walk
# order; a decoder that is asked for some names yields None in place of each other dataset, so
# that positions stay the same.
Decoder = Callable[..., Iterator[Entry | Fault | None]]
Wanted = Callable[[str], bool]

_DECODED = ("path string, error string, dataset_name string, group_name string,"
            "group_attrs map<string,string>, attrs map<string,string>, text string,"
            "shape array<int>, dtype string, data array<double>, seq bigint")
# as stored: with the fields of the file name, and the partition columns last
DECODED = (_DECODED + ", event_key string, event_ns bigint, event_ts timestamp, n1 bigint,"
           "n2 bigint, has_data boolean, event_date date")
_COLUMNS = ["path", "error", *Entry._fields, "seq"]
_ROWS_PER_FRAME = 5_000
_FILES_PER_TASK, _BYTES_PER_TASK = 64, 128 << 20


def _dtype(x) -> str:
    return ("bool" if isinstance(x, bool) else "int64" if isinstance(x, int)
            else "float64" if isinstance(x, float) else "object")


def _json_dataset(name: str, group: str, attrs: dict, item, arrays: bool) -> Entry:
    flat, shape = (item, [len(item)]) if isinstance(item, list) else ([item], [1])
    if flat and isinstance(flat[0], list):
        shape = [len(flat), len(flat[0])]
        if any(not isinstance(row, list) or len(row) != shape[1] for row in flat):
            raise ValueError("rows of different length")
        flat = [x for row in flat for x in row]
    kind = _dtype(flat[0]) if flat else "float64"
    text = None if len(flat) != 1 else str(flat[0])
    return Entry(name, group, attrs, {}, text, shape, kind, flat if arrays and len(flat) != 1 else None)


def as_numbers(data) -> list[float] | np.ndarray | None:
    """Values as double precision numbers; None where they are of another kind."""
    if isinstance(data, np.ndarray):
        return data.astype("float64") if data.dtype.kind in "iuf" else None
    if data is None or not all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in data):
        return None
    return [float(x) for x in data]


def decode_json(content: bytes, arrays: bool, wanted: Wanted | None = None) -> Iterator[Entry | Fault | None]:
    """JSON containers: objects are groups, their "@" member holds attributes, an object with a
    "@link" member alone stands for what lies at that path, all else is a dataset. A link is walked
    under its own name; one that leads nowhere, or back into a group it lies in, is a fault."""
    root = json.loads(content)

    def target(path: str):
        found, seen = root, set()
        for key in [k for k in path.split("/") if k]:
            found = found[key]
            while isinstance(found, dict) and set(found) == {"@link"}:
                if found["@link"] in seen:
                    raise ValueError("links in a circle")
                seen.add(found["@link"])
                found = target(found["@link"])
        return found

    def walk(group: dict, path: str, inside: tuple[int, ...]) -> Iterator[Entry | Fault | None]:
        attrs = {k: str(v) for k, v in group.get("@", {}).items()}
        for key, item in group.items():
            name = f"{path.rstrip('/')}/{key}"
            if key == "@":
                continue
            try:
                if isinstance(item, dict) and set(item) == {"@link"}:
                    item = target(item["@link"])
                if isinstance(item, dict):
                    if id(item) in inside:
                        raise ValueError("link into a group around it")
                    yield from walk(item, name, (*inside, id(item)))
                elif wanted is None or wanted(name):
                    yield _json_dataset(name, path, attrs, item, arrays)
                else:
                    yield None
            except (LookupError, TypeError, ValueError, RecursionError) as problem:
                yield Fault(name, repr(problem))

    yield from walk(root, "/", (id(root),))


def decode_hdf5(content: bytes, arrays: bool, wanted: Wanted | None = None) -> Iterator[Entry | Fault | None]:
    """HDF5 containers; needs h5py on the executors. Groups are walked by key, so soft and external
    links are followed and what lies behind them is found under the link's own name. A link that
    leads nowhere, or back into a group it lies in, and a dataset that cannot be read are faults."""
    import h5py

    def text_of(x) -> str:
        return x.decode("utf-8", "backslashreplace") if isinstance(x, bytes) else str(x)

    def attrs_of(node) -> dict[str, str]:
        return {k: text_of(v) for k, v in node.attrs.items()}

    def dataset(node, name: str, group: str, attrs: dict) -> Entry:
        one = node.size == 1
        values = node[()] if one or arrays else None
        return Entry(name, group, attrs, attrs_of(node),
                     text_of(values.flat[0] if node.shape else values) if one else None,
                     list(node.shape), node.dtype.str if node.dtype.kind == "S" else str(node.dtype),
                     None if one or values is None else values.ravel())

    def walk(group, path: str, inside: list) -> Iterator[Entry | Fault | None]:
        attrs = attrs_of(group)
        for key in group.keys():
            name = f"{path.rstrip('/')}/{key}"
            try:
                node = group[key]
                if isinstance(node, h5py.Dataset):
                    yield dataset(node, name, path, attrs) if wanted is None or wanted(name) else None
                elif any(node == around for around in inside):
                    raise ValueError("link into a group around it")
                else:
                    yield from walk(node, name, [*inside, node])
            except (LookupError, OSError, RuntimeError, TypeError, ValueError) as problem:
                yield Fault(name, repr(problem))

    with h5py.File(io.BytesIO(content), "r") as root:
        yield from walk(root, "/", [root])


def decoded_rows(decoder: Decoder, path: str, content: bytes | None, arrays: bool,
                 wanted: Wanted | None = None) -> list[tuple]:
    """Rows of one file in walk order: its datasets, a row with `error` for each fault, and a single
    one without a dataset if the file cannot be decoded at all, or read from its archive (no content)."""
    nothing = [None] * len(Entry._fields)
    rows: list[tuple] = []
    try:
        if content is None:
            raise ValueError("broken in its archive")
        takes_names = len(inspect.signature(decoder).parameters) > 2
        found = decoder(content, arrays, wanted) if takes_names else decoder(content, arrays)
        for seq, entry in enumerate(found):
            if isinstance(entry, Fault):
                rows.append((path, entry.error, entry.dataset_name, *nothing[1:], seq))
            elif entry is not None and (wanted is None or wanted(entry.dataset_name)):
                rows.append((path, None, *entry[:-1], as_numbers(entry.data), seq))
    except (ImportError, MemoryError):  # concerns the job, not this file
        raise
    except Exception as problem:  # any other decoder error concerns this file only
        rows = [(path, repr(problem), *nothing, None)]
    return rows


def decode_files(files: DataFrame, decoder: Decoder, arrays: bool = False) -> DataFrame:
    """One row per dataset of every file, with the fields of the file name. What cannot be decoded,
    a file or one of its datasets, yields a row with `error` set."""
    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for path, content in zip(batch["path"], batch["content"]):
                rows.extend(decoded_rows(decoder, path, None if content is None else bytes(content), arrays))
                if arrays or len(rows) >= _ROWS_PER_FRAME:
                    yield pd.DataFrame(rows, columns=_COLUMNS, dtype=object)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=_COLUMNS, dtype=object)

    decoded = files.select("path", "content").mapInPandas(run, _DECODED)
    return (decoded.withColumns(event_fields(F.col("path")))
            .withColumn("has_data", F.col("data").isNotNull()))


def decode_paths(files: DataFrame, decoder: Decoder, arrays: bool = False) -> DataFrame:
    """As decode_files, for a list of paths: every task opens its own files, so no other file is
    read. Files are dealt out by name, those of an archive together, to a number of tasks that follows
    from their number and size."""
    def run(batches):
        rows: list[tuple] = []
        reader = FileReader()
        for batch in batches:
            for path in batch["path"]:
                rows += decoded_rows(decoder, path, reader.read(path), arrays)
                if rows and (arrays or len(rows) >= _ROWS_PER_FRAME):
                    yield pd.DataFrame(rows, columns=_COLUMNS, dtype=object)
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=_COLUMNS, dtype=object)

    size = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(-(-size[0] // _FILES_PER_TASK), -(-size[1] // _BYTES_PER_TASK))
    # a task streams its files: many small ones need no more tasks
    dealt = files.select("path").repartition(task_count(files.sparkSession, tasks), opened_file(F.col("path")))
    decoded = dealt.sortWithinPartitions("path").mapInPandas(run, _DECODED)
    return (decoded.withColumns(event_fields(F.col("path")))
            .withColumn("has_data", F.col("data").isNotNull()))


def write_decoded(decoded: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store decoded rows, arrays apart from the rest and by day. The arrays are the bulk of an
    index and are written here once; no later step copies them. A sort inside each task, without
    a shuffle, brings the arrays of one dataset together, and small row groups, closed after few
    of the large rows, let a scan for one dataset skip the others. Days that are present are
    replaced, other days stay, as for all tables of an index that have days; with mode "append" rows
    are added to their days."""
    order = ["has_data", "event_date", "dataset_name", "event_key"]
    (decoded.sortWithinPartitions(*order)
     .write.mode(mode).partitionBy("has_data", "event_date")
     .option("partitionOverwriteMode", "dynamic")
     .option("parquet.block.size", 32 << 20)
     .option("parquet.page.size.row.check.min", 4)
     .parquet(path))


def read_decoded(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DECODED).parquet(path)


def leaf_rows(decoded: DataFrame) -> DataFrame:
    """Decoded datasets of well-named files in the stored leaf layout."""
    size = shape_size(F.col("shape"))
    value = value_by_dtype(size, F.col("dtype"), F.col("text"))
    return (decoded.where("error IS NULL AND event_key IS NOT NULL")
            .withColumns({"size": size, "value": value, "value_num": to_number(value),
                          **attr_triple(F.col("group_attrs"), F.col("attrs"))})
            .select(*LEAF.names))


def payload_rows(decoded: DataFrame) -> DataFrame:
    return decoded.where("has_data AND event_key IS NOT NULL").select(*PAYLOAD.names)


def undecodable(decoded: DataFrame) -> DataFrame:
    """Files, and single datasets of files, that could not be read; `dataset_name` is NULL where it
    is the whole file."""
    return decoded.where("error IS NOT NULL").select("path", "dataset_name", "error")
