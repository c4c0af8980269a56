"""Pivot to very many columns, with work in proportion to the leaf rows and the cells of the result.

The list of columns is joined to the leaf rows. Rows are combined to the first value per event and column,
then to one list per event, which is no longer than the list of columns. No row is tested against a column
that is not its own.

A list given as a dict makes columns of the schema: tasks scatter the lists of a batch of events into them at
once. Schema and plan of a table lie in the driver, so a list that grows with the data is given as a table,
and makes one column that holds the wide row as its cells.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from eventindex.operators.select import EVENT

CELLS = 4 << 20     # cells of the result that a task holds at once


def _cells(leaf: DataFrame, columns: DataFrame, value: str) -> DataFrame:
    """One row per event: `_cells`, its first values as (_no, v) in any order, each as many times as
    `columns` (dataset_name, _no, _times) lists it."""
    firsts = (leaf.join(columns, "dataset_name").groupBy(*EVENT, "_no", "_times")
              .agg(F.min_by(F.struct(F.col(value).alias("v")), "seq").alias("_first")))
    each = firsts.select(*EVENT, "_no", "_first", F.explode(F.array_repeat(F.lit(True), F.col("_times"))))
    return each.groupBy(*EVENT).agg(F.collect_list(F.struct("_no", F.col("_first.v").alias("v"))).alias("_cells"))


def cell(column) -> Column:
    """The value of one column of a wide row kept as cells; NULL where the event lacks it."""
    return F.get(F.filter("cells", lambda c: c["column"] == column), F.lit(0))["v"]


def pivot_wide(leaf: DataFrame, names: dict[str, str] | DataFrame, value: str = "value") -> DataFrame:
    """One row per event, with the first value of each dataset that is listed, matched by equality. Events
    with none of them are dropped.

    `names` as a dict (output column to dataset): one column per dataset; NULL where an event lacks it.
    `names` as a table (`column`: a number or a name, `dataset_name`) of any length: `cells`, an array of
    (column, v) in the order of the columns, without those that the event lacks. A column that is listed n
    times has n cells; see `cell` for one by its number or name."""
    if isinstance(names, DataFrame):
        listed = (names.groupBy("dataset_name", F.col("column").alias("_no"))
                  .agg(F.count("*").cast("int").alias("_times")))
        # merged, as a broadcast would take the list through the driver
        rows = _cells(leaf, listed.hint("merge"), value)
        named = F.transform(F.sort_array("_cells"), lambda c: F.struct(c["_no"].alias("column"), c["v"].alias("v")))
        return rows.select(*EVENT, named.alias("cells"))
    out = list(names)
    if len(set(names.values())) != len(out):
        raise ValueError("a dataset is asked for twice")
    spark = leaf.sparkSession
    numbers = spark.createDataFrame([(d, i, 1) for i, d in enumerate(names.values())],
                                    "dataset_name string, _no int, _times int")
    kind = leaf.schema[value].dataType
    rows = _cells(leaf, numbers, value)
    schema = T.StructType([*[leaf.schema[c] for c in EVENT], *[T.StructField(c, kind) for c in out]])

    def run(batches):
        import pyarrow as pa

        width, step = len(out), max(1, CELLS // max(1, len(out)))
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                cells = part.column("_cells")
                flat = cells.flatten()
                event = np.repeat(np.arange(part.num_rows), np.asarray(cells.value_lengths()))
                at = np.full((width, part.num_rows), -1, np.int64)
                at[flat.field("_no").to_numpy(), event] = np.arange(len(flat))
                values = flat.field("v")
                columns = [values.take(pa.array(row, mask=row < 0)) for row in at]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in EVENT], *columns], names=[*EVENT, *out])

    return rows.mapInArrow(run, schema)
