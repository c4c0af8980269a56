"""Arrays fetched from the event files themselves, without a stored payload."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from eventindex.session import task_count
from eventindex.sources.containers import Decoder, decoded_rows
from eventindex.sources.files import FileReader


def fetch_entries(rows: DataFrame, files: DataFrame, decoder: Decoder, files_per_task: int = 16) -> DataFrame:
    """Rows of (event_key, dataset_name, value, ...) with `path`, `data` and `missing`: the array is
    read from the event's file where there is no single value. `files` gives each event's path; an
    event in several files (a plain and a prefixed one) uses the first by name.

    Rows are brought together by event while they are narrow; each file is opened once, by the task
    that holds its rows, and only the datasets sought are decoded. Arrays are born after the last
    shuffle. `missing` tells why an array that was sought is not there: the file or the dataset.
    """
    where = files.groupBy("event_key").agg(F.min("path").alias("path"))
    names = rows.columns
    grouped = (rows.join(where, "event_key", "left")
               .groupBy("path", "event_key").agg(F.collect_list(F.struct(*names)).alias("_rows")))
    count = files.select("event_key").count()
    # a task streams its files: many need no more tasks
    dealt = grouped.repartition(task_count(rows.sparkSession, -(-count // files_per_task)), "path", "event_key")
    schema = T.StructType([*rows.schema.fields, T.StructField("path", T.StringType()),
                           T.StructField("data", T.ArrayType(T.DoubleType())), T.StructField("missing", T.StringType())])

    def run(batches):
        reader = FileReader()
        for batch in batches:
            for path, held in zip(batch["path"], batch["_rows"]):
                sought = {r["dataset_name"] for r in held if r["value"] is None}
                data, problem = {}, None
                if sought and path is None:
                    problem = "no file"
                elif sought:
                    try:
                        decoded = decoded_rows(decoder, path, reader.read(path), True, sought.__contains__)
                        data = {d[2]: d[-2] for d in decoded if d[1] is None}
                        problem = next((d[1] for d in decoded if d[1] and d[2] is None), None)
                    except OSError as error:
                        problem = repr(error)
                out = []
                for r in held:
                    found = data.get(r["dataset_name"]) if r["value"] is None else None
                    lacks = r["value"] is None and found is None
                    out.append((*[r[c] for c in names], path, found, (problem or "no array") if lacks else None))
                yield pd.DataFrame(out, columns=[f.name for f in schema.fields], dtype=object)

    return dealt.select("path", "_rows").mapInPandas(run, schema)
