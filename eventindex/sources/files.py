"""Event files: listing, names, rejects.

Folders are listed by tasks, level by level, and the files of a folder by the task that has it, so
that the driver never holds a list of files.

A zip file `*.h5.zip` is an archive: a folder of the files `*.h5` in it, each with the path
`<archive>!/<name>`. A small file takes a block and an inode of its own; in an archive it takes its bytes
and an entry in the list at the archive's end, which is all that a listing reads.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from fnmatch import fnmatchcase
from functools import reduce
from itertools import islice
from zipfile import BadZipFile, ZipFile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventindex.functions.names import event_fields, stem
from eventindex.session import new_path, task_count

CENTRAL = "/Central/"  # fixed value: folder of the dictionaries, never indexed
LISTED = "path string, modificationTime timestamp, length bigint"
ARCHIVE, INSIDE = ".zip", ".zip!/"
_ROWS, _BYTES = 1_000, 8 << 20


def store_of(path: str):
    """The file system of a path and the path in it; Hadoop writes local paths with one slash."""
    from pyarrow import fs

    local = re.match("(file:)?/+", path)
    if local:
        return fs.LocalFileSystem(), "/" + path[local.end():]
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


class FileReader:
    """Reads files by their listed paths. The archive used last stays open for the files after it.
    Paths are those of `store_of`, or of one store."""

    def __init__(self, store=None):
        self.store, self.path, self.file, self.archive = store, "", None, None

    def _file(self, path: str):
        store, where = store_of(path) if self.store is None else (self.store, path)
        return store.open_input_file(where)

    def _archive(self, path: str) -> ZipFile | None:
        """The archive at a path; None if the file is none."""
        if path != self.path:
            if self.file is not None:
                self.file.close()
            self.file, self.path, self.archive = self._file(path), path, None
            try:
                self.archive = ZipFile(self.file)
            except (BadZipFile, NotImplementedError, ValueError, struct.error) as problem:
                if isinstance(problem.__context__, OSError):  # concerns the store
                    raise problem.__context__ from None
        return self.archive

    def members(self, path: str, glob: str) -> Iterator[tuple[str, int | None]]:
        """Paths and sizes of an archive's files whose name fits; of the file itself if it is none."""
        archive = self._archive(path)
        if archive is None:
            yield path, None
            return
        for x in archive.NameToInfo.values():  # of entries with one name, the last counts
            parts = x.filename.split("/")
            if fnmatchcase(parts[-1], glob) and not x.is_dir() and not any(map(_hidden, parts)):
                yield f"{path}!/{x.filename}", x.file_size

    def read(self, path: str) -> bytes | None:
        """The content of a file; None if its archive holds it broken or encrypted."""
        outer, inside, name = path.partition(INSIDE)
        if not inside:
            with self._file(path) as file:
                return file.read()
        archive = self._archive(outer + ARCHIVE)
        if archive is None or name not in archive.NameToInfo:
            raise FileNotFoundError(path)
        try:
            return archive.read(name)
        except (BadZipFile, RuntimeError, EOFError, zlib.error):
            return None


def opened_file(path: Column) -> Column:
    """What is opened to read a file: the archive it lies in, or the file."""
    return F.substring_index(path, INSIDE, 1)


def _roots(spark: SparkSession, root: str | list[str]) -> list[tuple[str, bool]]:
    """Qualified paths below which to list, and whether they are folders."""
    found = []
    for text in [root] if isinstance(root, str) else root:
        path = spark._jvm.org.apache.hadoop.fs.Path(text)
        matches = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        if not matches:
            spark.read.format("binaryFile").load(text)  # raises Spark's own error
        found += [(x.getPath().toString(), x.isDirectory()) for x in matches]
    return found


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out as well."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(folder: str) -> Iterator[tuple]:
    from pyarrow.fs import FileSelector

    store, where = store_of(folder)
    for x in store.get_file_info(FileSelector(where)):
        if not _hidden(x.base_name):
            yield f"{folder.rstrip('/')}/{x.base_name}", x


def _folders(spark: SparkSession, roots: list[str]) -> DataFrame:
    """The folders and all folders below them; a job lists those of one level."""
    def run(batches):
        import pyarrow as pa
        from pyarrow.fs import FileType

        for batch in batches:
            for folder in batch.column("path").to_pylist():
                below = [path for path, x in _entries(folder) if x.type == FileType.Directory]
                if below:
                    yield pa.RecordBatch.from_arrays([pa.array(below, pa.string())], ["path"])

    levels, counts = [spark.createDataFrame([(path,) for path in roots], "path string")], [len(roots)]
    while counts[-1]:
        stored = new_path(spark, "folders")
        dealt = levels[-1].repartition(task_count(spark, counts[-1]), "path")
        dealt.mapInArrow(run, "path string").write.parquet(stored)
        levels.append(spark.read.schema("path string").parquet(stored))
        counts.append(levels[-1].count())
    return reduce(DataFrame.unionAll, levels[:-1]).repartition(task_count(spark, sum(counts)), "path")


def listed_files(spark: SparkSession, root: str | list[str], glob: str, archives: bool = False) -> DataFrame:
    """Files below the root, or several, whose name fits: path, modificationTime, length. On request
    with the files of archives, which have the time of their archive. An archive that cannot be opened
    is listed itself, and so are all in a store that only Spark can open."""
    roots = _roots(spark, root)
    names = f"{{{glob},{glob}{ARCHIVE}}}" if archives else glob
    try:
        store_of(roots[0][0])
    except (ValueError, OSError):  # a store that only Spark can open is listed by Spark
        return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                .option("pathGlobFilter", names).load(root).select("path", "modificationTime", "length"))

    def files_of(reader: FileReader, path: str, time, length: int) -> Iterator[tuple]:
        base = path.rsplit("/", 1)[1]
        if fnmatchcase(base, glob):
            yield path, time, length
        elif archives and fnmatchcase(base, glob + ARCHIVE):
            for member, size in reader.members(path, glob):
                yield member, time, length if size is None else size

    def run(batches):
        import pyarrow as pa
        from pyarrow.fs import FileType

        kinds = [pa.string(), pa.timestamp("us", "UTC"), pa.int64()]
        reader = FileReader()
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                # times in milliseconds, as Hadoop has them
                rows = (row for path, x in _entries(folder) if x.type == FileType.File
                        for row in files_of(reader, path, None if x.mtime_ns is None else x.mtime_ns // 10**6 * 1000, x.size))
                while part := list(islice(rows, 10 * _ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)],
                                                     ["path", "modificationTime", "length"])

    def unpack(batches):
        import pyarrow as pa

        reader = FileReader()
        for batch in batches:
            rows = (row for file in zip(*[c.to_pylist() for c in batch.columns]) for row in files_of(reader, *file))
            while part := list(islice(rows, 10 * _ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), batch.schema)],
                                                 batch.schema.names)

    folders, single = [p for p, is_folder in roots if is_folder], [p for p, is_folder in roots if not is_folder]
    files = [_folders(spark, folders).mapInArrow(run, LISTED)] if folders else []
    if single:
        alone = (spark.read.format("binaryFile").option("pathGlobFilter", names).load(single)
                 .select("path", "modificationTime", "length"))
        files.append(alone.mapInArrow(unpack, LISTED) if archives else alone)
    return reduce(DataFrame.unionAll, files)


def scan_files(spark: SparkSession, root: str | list[str], extension: str = "h5") -> DataFrame:
    """All files below the root, or several; none is opened. Those of an archive are read from its list."""
    return (listed_files(spark, root, f"*.{extension}", archives=True).where(~F.col("path").contains(CENTRAL))
            .select("path", "length", "modificationTime"))


def binary_files(spark: SparkSession, root: str | list[str], extension: str = "h5") -> DataFrame:
    """As scan_files, with the `content`. Files are dealt to tasks by name, those of an archive to one,
    and read one by one. A file that its archive holds broken has no content."""
    files = scan_files(spark, root, extension).select("path", "modificationTime", "length")
    try:
        store_of(_roots(spark, root)[0][0])
    except (ValueError, OSError):
        return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                .option("pathGlobFilter", f"{{*.{extension},*.{extension}{ARCHIVE}}}").load(root)
                .where(~F.col("path").contains(CENTRAL)))

    def run(batches):
        import pyarrow as pa

        reader = FileReader()
        for batch in batches:
            read, size, first = [], 0, 0
            for at, path in enumerate(batch.column("path").to_pylist(), 1):
                read.append(reader.read(path))
                size += len(read[-1] or b"")
                if size >= _BYTES or len(read) >= _ROWS or at == batch.num_rows:
                    part = batch.slice(first, len(read))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(read, pa.binary())],
                                                     [*part.schema.names, "content"])
                    read, size, first = [], 0, at

    dealt = files.repartition(task_count(spark), opened_file(F.col("path"))).sortWithinPartitions("path")
    return dealt.mapInArrow(run, f"{LISTED}, content binary")


def named_events(files: DataFrame) -> DataFrame:
    """Files with the fields of their name; all NULL when the name is malformed."""
    return files.withColumns(event_fields(F.col("path")))


def events_of(files: DataFrame) -> DataFrame:
    return (named_events(files).where("event_key IS NOT NULL")
            .select("event_key", "event_ns", "event_ts", "n1", "n2", "path", "event_date"))


def rejected_names(files: DataFrame) -> DataFrame:
    """Files whose name is malformed. They are reported and drop nothing but themselves."""
    return named_events(files).where("event_key IS NULL").select(*files.columns)


def join_by_stem(left: DataFrame, right: DataFrame, left_path: str, right_path: str) -> DataFrame:
    """Pair the files of two trees whose names differ only in folder and extension."""
    return (left.withColumn("stem", stem(F.col(left_path)))
            .join(right.withColumn("stem", stem(F.col(right_path))), "stem"))
