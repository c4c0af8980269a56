"""CSV records that may hold line breaks, read by several tasks per file.

A line break ends a record unless it is quoted, and whether it is quoted depends on all quotes before
it. Files are read as plain lines, so that large ones are split. Each piece counts its quotes; the
running parity over the pieces of a file tells every piece in which state it begins, and so every
line whether it starts a record. Records that span lines, or pieces, are put together by number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from eventindex.session import task_count
from eventindex.sources.files import listed_files, store_of

QUOTE = '"'
_ROWS = 10_000


def quoted_records(spark: SparkSession, path: str | list[str], glob: str = "*.csv") -> DataFrame:
    """One row per record: path, record (number in its file, from 0) and text. Empty lines between
    records are no records."""
    return number_records(file_pieces(spark, listed_files(spark, path, glob)))


def piece_lines(file, start: int, size: int) -> list[bytes]:
    """The lines that begin in a piece of a file, the last one to its end."""
    file.seek(max(0, start - 1))
    data = file.read(size + (start > 0))
    if start:
        before = data.find(b"\n")
        data = data[before + 1:] if before >= 0 else b""
    elif data.startswith(b"\xef\xbb\xbf"):
        data = data[3:]
    if not data:
        return []
    parts = [data]
    while not parts[-1].endswith(b"\n") and (more := file.read(1 << 16)):
        end = more.find(b"\n") + 1
        parts.append(more[:end] if end else more)
    lines = b"".join(parts).split(b"\n")
    return lines if lines[-1] else lines[:-1]


def file_pieces(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Lines of files (path, length) for `number_records`. Pieces, of spark.sql.files.maxPartitionBytes,
    are dealt to tasks by name, so that neither many small files nor a large one make a task of their own."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))

    def run(batches):
        import pyarrow as pa

        held: list[list] = [[], [], [], []]

        def out():
            paths, pieces, numbers, texts = held
            # as bytes, for a text need not be valid
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(pieces, pa.int64()), pa.array(numbers, pa.int64()),
                 pa.array(texts, pa.binary()).view(pa.string())], ["path", "piece", "line", "value"])

        for batch in batches:
            for path, piece in zip(batch.column("path").to_pylist(), batch.column("piece").to_pylist()):
                store, where = store_of(path)
                with store.open_input_file(where) as file:
                    lines = piece_lines(file, piece, size)
                for first in range(0, len(lines), _ROWS):
                    part = lines[first:first + _ROWS]
                    for column, values in zip(held, ([path] * len(part), [piece] * len(part),
                                                     range(first, first + len(part)), part)):
                        column.extend(values)
                    if len(held[0]) >= _ROWS:
                        yield out()
                        held = [[], [], [], []]
        if held[0]:
            yield out()

    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("bigint"))
    pieces = files.select("path", F.explode(starts).alias("piece"))
    return (pieces.repartition(task_count(spark), "path", "piece")
            .mapInArrow(run, "path string, piece bigint, line bigint, value string"))


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(QUOTE), F.lit("")))


def number_records(lines: DataFrame) -> DataFrame:
    """Records of lines (path, piece, line, value): `line` orders the lines of a piece, `piece` the
    pieces of a file. No task sees more than a piece, or the list of a file's pieces.

    Lines are numbered for both states in which a piece may begin, so they are dealt out once for the
    counts of the pieces and for the numbers: both plans begin with the same shuffle. Spark reuses it, but
    for lines that come from a Python task, which are computed twice."""
    inside = Window.partitionBy("path", "piece").orderBy("line")
    before = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # an empty line where a record could start is none
    empty = F.regexp_replace("value", "\r$", "") == ""
    marked = (lines.withColumn("quotes", _quotes(F.col("value"))).withColumn("even", before % 2 == 0)
              .withColumns({"empty": empty, "if_shut": F.count_if(F.col("even") & ~empty).over(inside),
                            "if_open": F.count_if(~F.col("even") & ~empty).over(inside)}))
    pieces = marked.groupBy("path", "piece").agg(
        F.sum("quotes").alias("quotes"), F.max("if_shut").alias("n_shut"), F.max("if_open").alias("n_open"))
    earlier = Window.partitionBy("path").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    shut = F.col("shut")
    states = (pieces.withColumn("shut", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 0)
              .withColumn("offset", F.coalesce(F.sum(F.when(shut, F.col("n_shut")).otherwise(F.col("n_open")))
                                               .over(earlier), F.lit(0)))
              .select("path", "piece", "shut", "offset"))
    numbered = (marked.join(states, ["path", "piece"]).where(~(F.col("empty") & (F.col("even") == shut)))
                .withColumn("record", F.col("offset") + F.when(shut, F.col("if_shut")).otherwise(F.col("if_open")) - 1))
    whole = F.array_sort(F.collect_list(F.struct("piece", "line", "value")))
    text = F.array_join(F.transform(whole, lambda x: x["value"]), "\n")
    return (numbered.groupBy("path", "record").agg(text.alias("text"))
            .withColumn("text", F.regexp_replace("text", "\r$", "")))


def parse_records(records: DataFrame, schema: T.StructType, options: dict[str, str], header: bool = True) -> DataFrame:
    """Records as columns, beside path and record; `header` leaves the first record of a file out."""
    rows = records.where("record > 0") if header else records
    parsed = F.from_csv(F.col("text"), _ddl(schema), options)
    return rows.select("path", "record", parsed.alias("_row")).select("path", "record", "_row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
