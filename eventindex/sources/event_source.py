"""Event files as a Spark data source: `spark.read.format("event_files")`.

A read is planned by day folder. Filters on `event_date` choose the folders that are listed, and
filters on `dataset_name` the datasets that a decoder reads from a file; Spark evaluates all of
them again on the rows. Files of a day are dealt to tasks in portions, so a long day is split; an archive
(see `files`) is a portion, and its list is read by the task that has it.

Options: `path`, the root of year/month/day folders; `decoder`, as `module:function`; `extension`;
`arrays`, whether arrays are read; `files_per_task`.
"""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable, Iterator
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

from eventindex.functions.names import event_fields
from eventindex.sources.containers import decoded_rows
from eventindex.sources.files import ARCHIVE, FileReader

FORMAT = "event_files"
FILES_PER_TASK = 64
SCHEMA = ("path string, error string, dataset_name string, group_name string, group_attrs map<string,string>,"
          "attrs map<string,string>, text string, shape array<int>, dtype string, data array<double>, seq bigint,"
          "event_date date")
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
_FOLDER = (r"\d{4}", r"\d{1,2}", r"\d{1,2}")  # fixed values: year, month, day
_ROWS = 5_000

Test = Callable[[object], bool]


def as_test(f: ds.Filter) -> Test | None:
    """A pushed filter as a test of one value; None if it says nothing this source can use."""
    # a null never passes these comparisons
    tests = {
        ds.EqualTo: lambda v: lambda x: x == v,
        ds.EqualNullSafe: lambda v: lambda x: x == v,
        ds.In: lambda v: lambda x: x in v,
        ds.GreaterThan: lambda v: lambda x: x > v,
        ds.GreaterThanOrEqual: lambda v: lambda x: x >= v,
        ds.LessThan: lambda v: lambda x: x < v,
        ds.LessThanOrEqual: lambda v: lambda x: x <= v,
        ds.StringStartsWith: lambda v: lambda x: x.startswith(v),
        ds.StringEndsWith: lambda v: lambda x: x.endswith(v),
        ds.StringContains: lambda v: lambda x: v in x,
    }
    made = tests.get(type(f))
    value = getattr(f, "value", None)
    return None if made is None or value is None else made(value)


class Portion(ds.InputPartition):
    """Files of one day, or an archive."""

    def __init__(self, day: date, files: list[str]):
        self.day, self.files = day, files


def day_folders(fs, root: str, wanted: Callable[[date], bool] = lambda day: True) -> list[tuple[date, str]]:
    """The day folders below a root; folders of years and months are listed, never the files."""
    from pyarrow.fs import FileSelector, FileType

    def below(folder: str, level: int) -> list[str]:
        return [x.path for x in fs.get_file_info(FileSelector(folder))
                if x.type == FileType.Directory and re.fullmatch(_FOLDER[level], x.base_name)]

    found = []
    for year in below(root, 0):
        for month in below(year, 1):
            for folder in below(month, 2):
                parts = [int(x) for x in folder.rsplit("/", 3)[1:]]
                try:
                    day = date(*parts)
                except ValueError:
                    continue  # no day of the calendar
                if wanted(day):
                    found.append((day, folder))
    return sorted(found)


class EventFileReader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.options = options["path"], options
        self.days: list[Test] = []
        self.names: list[Test] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for f in filters:
            test = as_test(f)
            if test is not None and f.attribute == ("event_date",):
                self.days.append(test)
            elif test is not None and f.attribute == ("dataset_name",):
                self.names.append(test)
            yield f  # all are evaluated again on the rows

    def store(self):
        from pyarrow.fs import FileSystem

        return FileSystem.from_uri(self.root)

    def partitions(self) -> list[Portion]:
        from pyarrow.fs import FileSelector, FileType

        fs, root = self.store()
        ending = "." + self.options.get("extension", "h5")
        size = int(self.options.get("files_per_task", FILES_PER_TASK))
        out: list[Portion] = []
        for day, folder in day_folders(fs, root, lambda d: all(t(d) for t in self.days)):
            found = sorted(x.path for x in fs.get_file_info(FileSelector(folder, recursive=True))
                           if x.type == FileType.File and x.base_name.endswith((ending, ending + ARCHIVE)))
            files = [x for x in found if x.endswith(ending)]
            out += [Portion(day, files[k:k + size]) for k in range(0, len(files), size)]
            out += [Portion(day, [x]) for x in found if not x.endswith(ending)]
        return out or [Portion(date.min, [])]

    def read(self, portion: Portion) -> Iterator:
        import pyarrow as pa

        reader, ending = FileReader(self.store()[0]), "." + self.options.get("extension", "h5")
        module, name = self.options["decoder"].split(":")
        decoder = getattr(importlib.import_module(module), name)
        arrays = self.options.get("arrays", "false").lower() == "true"
        wanted = (lambda name: all(t(name) for t in self.names)) if self.names else None
        schema = arrow_schema()
        rows: list[tuple] = []

        def batch():
            columns = [[*c] for c in zip(*rows)] if rows else [[] for _ in schema]
            arrays_ = [pa.array([None if x is None else list(x.items()) if isinstance(x, dict) else x for x in c], f.type)
                       for c, f in zip(columns, schema)]
            return pa.RecordBatch.from_arrays(arrays_, schema=schema)

        for file in portion.files:
            members = [file] if file.endswith(ending) else [path for path, _ in reader.members(file, "*" + ending)]
            for path in members:
                rows += [(*r, portion.day) for r in decoded_rows(decoder, path, reader.read(path), arrays, wanted)]
                if arrays or len(rows) >= _ROWS:
                    yield batch()
                    rows.clear()
        if rows:
            yield batch()


def arrow_schema():
    import pyarrow as pa

    text, attrs = pa.string(), pa.map_(pa.string(), pa.string())
    return pa.schema([("path", text), ("error", text), ("dataset_name", text), ("group_name", text),
                      ("group_attrs", attrs), ("attrs", attrs), ("text", text), ("shape", pa.list_(pa.int32())),
                      ("dtype", text), ("data", pa.list_(pa.float64())), ("seq", pa.int64()), ("event_date", pa.date32())])


class EventFiles(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> EventFileReader:
        return EventFileReader(dict(self.options))


def read_events(spark: SparkSession, root: str, decoder: str, arrays: bool = False, extension: str = "h5",
                files_per_task: int = FILES_PER_TASK) -> DataFrame:
    """Decoded datasets of the event files below root, lazily, in the layout of `decode_files`: one
    row per dataset, with the fields of the file name. The day is that of the folder. `decoder` names
    a function, as `eventindex.sources.containers:decode_json`."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(EventFiles)
    rows = (spark.read.format(FORMAT).option("decoder", decoder).option("arrays", str(arrays).lower())
            .option("extension", extension).option("files_per_task", str(files_per_task)).load(root))
    fields = event_fields(F.col("path"))
    return (rows.withColumns({k: v for k, v in fields.items() if k != "event_date"})
            .withColumn("has_data", F.col("data").isNotNull()))
