"""Logical inputs derived from the given tables, in Spark and (below) as SQL views."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventindex.functions.times import day_dir, local_day, ns_to_ts
from eventindex.operators.dictionaries import distinct_names
from eventindex.plans.api import EventIndex
from eventindex.session import new_path, task_count
from eventindex.sources.files import ARCHIVE, store_of

ROOT = "/data"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` with the file name and path each event would have."""
    ns = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    key = F.concat_ws("_", ns, "user_id", "event_id")
    ts = ns_to_ts(ns)
    path = F.concat(F.lit(ROOT + "/"), day_dir(local_day(ts)), F.lit("/"), key, F.lit(".h5"))
    return table(spark, sf_dir, "events").withColumns({
        "event_key": key, "event_ns": ns, "event_ts": ts, "n1": F.col("user_id"),
        "n2": F.col("event_id"), "event_date": local_day(ts), "path": path})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(spark, sf_dir).select("event_key", "event_ns", "event_ts", "n1", "n2",
                                            "path", "event_date")


class Field(NamedTuple):
    """One dataset per row, as SQL: where it sits, and its value as text and as a number."""
    group: str
    name: str
    value: str
    number: str = "NULL"
    shape: tuple[int, ...] = (1,)
    dtype: str = "float64"


def _leaf(rows: DataFrame, fields: list[Field], order: str = "CAST(_i AS bigint)") -> DataFrame:
    """Rows in the leaf layout, one per row and field. Only the field number is generated; all
    columns are expressions of it, so those a query does not read are never computed."""
    def pick(of) -> str:
        texts = [of(f) for f in fields]
        if len(set(texts)) == 1:
            return texts[0]
        return "CASE _i" + "".join(f" WHEN {i} THEN {t}" for i, t in enumerate(texts)) + " END"

    group = pick(lambda f: f.group)
    numbers = ", ".join(str(i) for i in range(len(fields)))
    texts = pick(lambda f: f"'{f.name}'")
    columns = {
        "event_key": "event_key",
        "event_ts": "event_ts",
        "dataset_name": f"concat({group}, '/', {texts})",
        "group_name": group,
        "attrs": "CAST(NULL AS map<string,string>)",
        "comment": "CAST(NULL AS string)",
        "acq_stamp": "CAST(NULL AS string)",
        "exception": "CAST(NULL AS string)",
        "value": pick(lambda f: f"CAST({f.value} AS string)"),
        "value_num": pick(lambda f: f"CAST({f.number} AS double)"),
        "shape": pick(lambda f: f"array({', '.join(map(str, f.shape))})"),
        "size": f"CAST({pick(lambda f: str(math.prod(f.shape)))} AS bigint)",
        "dtype": pick(lambda f: f"'{f.dtype}'"),
        "seq": order,
        "event_date": "event_date",
    }
    return (rows.selectExpr("*", f"explode(array({numbers})) AS _i")
            .selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()]))


MEASURES = ["quantity", "extendedprice", "discount", "tax"]


def leaf_lines(spark: SparkSession, sf_dir: str, on: str = "l_orderkey") -> DataFrame:
    """Order = event, line number = group, four measures = datasets. An order may repeat a line
    number, so "first match" matters; line, field, part and price make the walk order unique.
    Joined on "event_key", the rows come dealt out by event, as an aggregation per event needs them."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("timestamp")
        .alias("event_ts")).withColumn("event_date", local_day(F.col("event_ts")))
    if on == "event_key":
        orders = orders.withColumn("event_key", F.col("l_orderkey").cast("string")).drop("l_orderkey")
    lines = table(spark, sf_dir, "lineitem").withColumn("event_key",
                                                        F.col("l_orderkey").cast("string"))
    # by part as well: one order may hold a large share of all lines
    rows = lines.join(orders, on)
    seq = f"""(CAST(l_linenumber AS bigint) * 4 + _i) * {1 << 58} + l_partkey * {1 << 24}
      + CAST(round(l_extendedprice * 100) AS bigint)"""
    return _leaf(rows, [Field("concat('/line', l_linenumber)", m, f"l_{m}", f"l_{m}")
                        for m in MEASURES], seq)


INFO = """concat('slit width="', CASE event_type WHEN 'click' THEN '20.0' WHEN 'view' THEN '20'
  ELSE '35.5' END, '",shutter="', CASE WHEN value < 150 THEN 'open' ELSE 'closed' END, '",',
  CASE event_type WHEN 'signup' THEN 'focus lens' WHEN 'error' THEN 'focus time 3'
  ELSE 'mode operate' END)"""  # the same in both dialects


def leaf_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event = shot with source and camera settings; shots with an embedding also have an image
    group, whose array is in `payload`."""
    images = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("event_id"), "label")
    rows = event_rows(spark, sf_dir).join(images, "event_id", "left")
    source, camera, image = "'/beam/source'", "'/streak/camera'", "concat('/cam', label, '/image')"
    exposure = "CASE WHEN event_type IN ('click', 'view') THEN '100 ms' ELSE '50 ms' END"
    fields = [
        Field(source, "intensity", "value", "value"),
        Field(source, "user", "user_id", "user_id", dtype="int64"),
        Field(camera, "exposure", exposure, dtype="object"),
        Field(camera, "timeRange", "CASE WHEN value < 50 THEN '200 ps' ELSE '1 ns' END",
              dtype="object"),
        Field(camera, "info", INFO, dtype="object"),
        Field(image, "data", "NULL", shape=(8, 8)),
        Field(image, "width", "'8'", "8", dtype="int64"),
        Field(image, "height", "'8'", "8", dtype="int64"),
    ]
    # the image group exists only where there is an image
    return _leaf(rows, fields).where("group_name IS NOT NULL")


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = table(spark, sf_dir, "embeddings")
    rows = event_rows(spark, sf_dir).select("event_id", "event_key", "event_date")
    return images.join(rows, F.col("vec_id") == F.col("event_id")).select(
        "event_key", F.concat(F.lit("/cam"), F.col("label"), F.lit("/image/data"))
        .alias("dataset_name"), F.col("embedding").cast("array<double>").alias("data"),
        "event_date")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts as comments; the dataset is named after the document."""
    return table(spark, sf_dir, "documents").select(
        F.col("text").alias("comment"), F.col("doc_id").cast("bigint").alias("seq"),
        F.concat(F.lit("/doc/"), F.col("doc_id")).alias("dataset_name"))


def lines_index(spark: SparkSession, sf_dir: str) -> EventIndex:
    leaf = leaf_lines(spark, sf_dir)
    # the dictionary of names, from the distinct groups instead of all leaf rows
    groups = table(spark, sf_dir, "lineitem").select("l_linenumber").distinct()
    fields = F.explode(F.array(*[F.lit(m) for m in MEASURES])).alias("field")
    names = groups.select("l_linenumber", fields).select(
        F.concat(F.lit("/line"), "l_linenumber", F.lit("/"), "field").alias("dataset_name"))
    no_comments = spark.createDataFrame([], "comment string, dataset_name string")
    return EventIndex(leaf_events(leaf), leaf, names, no_comments, root=ROOT)


def shots_index(spark: SparkSession, sf_dir: str) -> EventIndex:
    labels = table(spark, sf_dir, "embeddings").select("label").distinct()
    group = F.concat(F.lit("/cam"), F.col("label"), F.lit("/image"))
    own = [F.concat(group, F.lit("/" + f)) for f in ("data", "width", "height")]
    shared = [F.lit(n) for n in ("/beam/source/intensity", "/beam/source/user",
                                 "/streak/camera/exposure", "/streak/camera/timeRange",
                                 "/streak/camera/info")]
    names = labels.select(group.alias("group"),
                          F.explode(F.array(*own, *shared)).alias("dataset_name"))
    # a comment per camera, so comment search finds what keyword search cannot
    about = names.where("dataset_name LIKE '%/image/data'").select(
        F.concat(F.lit("Frames of "), F.upper("group")).alias("comment"), "dataset_name")
    return EventIndex(events(spark, sf_dir), leaf_shots(spark, sf_dir),
                      distinct_names(names), about, payload(spark, sf_dir), root=ROOT)


def leaf_events(leaf: DataFrame) -> DataFrame:
    return leaf.select("event_key", "event_ts", "event_date").distinct()


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 x 8 frames with metadata; label 0 lacks a height and is no image. The
    time axis has nine samples, the last one broken."""
    return (table(spark, sf_dir, "embeddings")
            .withColumn("data", F.col("embedding").cast("array<double>"))
            .withColumn("side", F.sqrt(F.size("embedding")).cast("int"))
            .withColumn("metadata", F.map_from_arrays(
                F.array(F.lit("imageWidth"), F.when(F.col("label") == 0, "rows")
                        .otherwise("ImageHEIGHT"), F.lit("label")),
                F.array(F.col("side").cast("string"), F.col("side").cast("string"),
                        F.col("label").cast("string"))))
            .withColumn("axis", F.concat(
                F.transform(F.sequence(F.lit(0), F.lit(7)),
                            lambda i: i * (F.col("label") + 10.0)), F.array(F.lit(0.0)))))


_trees: dict[tuple[str, str], str] = {}


def container_tree(spark: SparkSession, sf_dir: str) -> str:
    """One JSON container per event in archives in year/month/day folders below the shared folder, plus
    one per day in `Central` that the index must skip. Written once per session and data set."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known in _trees:
        return _trees[known]
    root = new_path(spark, "tree")
    beam = F.struct(F.col("value").alias("intensity"), F.col("user_id").alias("user"),
                    F.array("value", "user_id").alias("pair"))
    content = F.to_json(F.struct(
        F.struct(F.concat(F.lit("shot of "), "event_type").alias("comment")).alias("@"),
        beam.alias("beam"), F.col("event_type").alias("kind")))
    rows = event_rows(spark, sf_dir).select(
        F.regexp_replace("path", f"^{ROOT}", root).alias("path"),
        content.alias("content"), "event_date")
    central = rows.groupBy("event_date").agg(F.max("content").alias("content")).select(
        F.concat(F.lit(root + "/Central/"), F.col("event_date"), F.lit(".h5")).alias("path"),
        "content")

    _write_archives(rows.select("path", "content"))
    _write_tree(central)
    _trees[known] = root
    return root


def _write_tree(files: DataFrame) -> None:
    """One file per row of (path, content)."""
    def write(batches):
        import os

        made = set()
        for batch in batches:
            for path, text in zip(batch["path"], batch["content"]):
                store, where = store_of(path)
                folder = os.path.dirname(where)
                if folder not in made:
                    store.create_dir(folder)
                    made.add(folder)
                with store.open_output_stream(where) as out:
                    out.write(text.encode())
            yield batch[["path"]]

    dealt = files.repartition(task_count(files.sparkSession), "path")
    dealt.mapInPandas(write, "path string").write.format("noop").mode("overwrite").save()


ARCHIVE_FILES, ARCHIVE_BYTES = 1_000, 64 << 20  # about the most in one archive


def _write_archives(files: DataFrame) -> None:
    """One file per row of (path, content), in archives that lie in the file's folder and are named
    after their first file. Of rows with one path one counts, as if it were written over the others."""
    def write(batches):
        import io
        import os
        import zipfile

        folder, held, size = "", {}, 0

        def put():
            store, where = store_of(f"{folder}/{next(iter(held))}{ARCHIVE}")
            store.create_dir(os.path.dirname(where))
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w") as archive:
                for name, content in held.items():
                    archive.writestr(name, content)
            with store.open_output_stream(where) as out:
                out.write(packed.getbuffer())

        for batch in batches:
            for path, text in zip(batch["path"], batch["content"]):
                content, (above, name) = text.encode(), path.rsplit("/", 1)
                full = len(held) >= ARCHIVE_FILES or size >= ARCHIVE_BYTES
                if held and (above != folder or full and name not in held):
                    put()
                    held, size = {}, 0
                folder, held[name], size = above, content, size + len(content)
            yield batch[["path"]]
        if held:
            put()

    # by ranges, so that a folder lies in few tasks and rows with one path in one
    dealt = files.repartitionByRange(task_count(files.sparkSession), "path").sortWithinPartitions("path")
    dealt.mapInPandas(write, "path string").write.format("noop").mode("overwrite").save()


def located_index(spark: SparkSession, sf_dir: str) -> EventIndex:
    """The shots without a stored payload: images lie in one JSON container per event."""
    known = (spark.sparkContext.applicationId, sf_dir + "#images")
    if known not in _trees:
        root = new_path(spark, "images")
        data = F.col("embedding").cast("array<double>")
        frame = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice(data, r * 8 + 1, 8))
        image = F.struct(F.struct(frame.alias("data"), F.lit(8).alias("width"), F.lit(8).alias("height")).alias("image"))
        content = F.to_json(F.create_map(F.concat(F.lit("cam"), "label"), image))
        rows = table(spark, sf_dir, "embeddings").join(
            event_rows(spark, sf_dir), F.col("vec_id") == F.col("event_id"))
        _write_tree(rows.select(F.regexp_replace("path", f"^{ROOT}", root).alias("path"), content.alias("content")))
        _trees[known] = root
    ix = shots_index(spark, sf_dir)
    listed = ix.events.withColumn("path", F.regexp_replace("path", f"^{ROOT}", _trees[known]))
    return EventIndex(listed, ix.leaf, ix.names, ix.comments, root=_trees[known])


FRAME = (6, 4)  # rows and columns of the frames in `typed_files`


def typed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A container per event: a frame of 16-bit pixels, 19-digit time stamps, and words."""
    pixels = F.transform(F.sequence(F.lit(0), F.lit(FRAME[0] * FRAME[1] - 1)),
                         lambda i: F.pmod(F.col("user_id") * 7919 + i * 2633, F.lit(65536)))
    content = F.to_json(F.struct(
        pixels.alias("pixels"), F.array("event_ns", F.col("event_ns") + 1, F.col("event_ns") + 2).alias("stamps"),
        F.array(F.col("event_type"), F.concat(F.lit('q"'), "user_id")).alias("words")))
    files = event_rows(spark, sf_dir).select("path", content.cast("binary").alias("content"))
    return files.repartition(task_count(spark), "path")


def decode_typed(content: bytes, arrays: bool):
    """The containers of `typed_files`, with the pixels in the type a camera gives."""
    import json

    import numpy as np
    from eventindex.sources.containers import Entry

    held = json.loads(content)
    yield Entry("/cam/pixels", "/cam", {}, {}, None, list(FRAME), "uint16", np.array(held["pixels"], "u2"))
    yield Entry("/cam/stamps", "/cam", {}, {}, None, [3], "int64", held["stamps"])
    yield Entry("/cam/words", "/cam", {}, {}, None, [2], "object", held["words"])


# --- the same inputs as SQL views --------------------------------------------------------

EV = """ev AS (
  SELECT *, epoch_us(ts) * 1000 AS event_ns,
    (epoch_us(ts) * 1000)::VARCHAR || '_' || user_id || '_' || event_id AS event_key,
    epoch_us(ts) // 1000000 AS event_s,
    timezone('Europe/Zurich', timezone('UTC', ts))::DATE AS event_date,
    '/data/' || strftime(timezone('Europe/Zurich', timezone('UTC', ts)), '%Y/%m/%d') || '/'
      || (epoch_us(ts) * 1000)::VARCHAR || '_' || user_id || '_' || event_id || '.h5' AS path
  FROM events)"""

LINES = """leaf AS (
  SELECT o_orderkey::VARCHAR AS event_key, epoch(o_orderdate)::BIGINT AS event_s,
    timezone('Europe/Zurich', timezone('UTC', o_orderdate))::DATE AS event_date,
    '/line' || l_linenumber AS group_name,
    '/line' || l_linenumber || '/' || field AS dataset_name,
    v AS value_num, v::VARCHAR AS value,
    (l_linenumber * 4 + pos)::BIGINT * 288230376151711744 + l_partkey * 16777216
      + round(l_extendedprice * 100)::BIGINT AS seq
  FROM (
    SELECT *, 'quantity' AS field, 0 AS pos, l_quantity AS v FROM lineitem UNION ALL
    SELECT *, 'extendedprice', 1, l_extendedprice FROM lineitem UNION ALL
    SELECT *, 'discount', 2, l_discount FROM lineitem UNION ALL
    SELECT *, 'tax', 3, l_tax FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey)"""

SHOTS = f"""{EV}, cam AS (
  SELECT ev.*, label, embedding, '/cam' || label || '/image' AS image_group
  FROM ev JOIN embeddings ON vec_id = event_id),
leaf AS (
  SELECT event_key, event_s, event_date, '/beam/source' AS group_name,
    '/beam/source/intensity' AS dataset_name, value::VARCHAR AS value, 0 AS seq FROM ev UNION ALL
  SELECT event_key, event_s, event_date, '/beam/source', '/beam/source/user',
    user_id::VARCHAR, 1 FROM ev UNION ALL
  SELECT event_key, event_s, event_date, '/streak/camera', '/streak/camera/exposure',
    CASE WHEN event_type IN ('click', 'view') THEN '100 ms' ELSE '50 ms' END, 2 FROM ev UNION ALL
  SELECT event_key, event_s, event_date, '/streak/camera', '/streak/camera/timeRange',
    CASE WHEN value < 50 THEN '200 ps' ELSE '1 ns' END, 3 FROM ev UNION ALL
  SELECT event_key, event_s, event_date, '/streak/camera', '/streak/camera/info',
    {INFO}, 4 FROM ev UNION ALL
  SELECT event_key, event_s, event_date, image_group, image_group || '/data', NULL, 5
    FROM cam UNION ALL
  SELECT event_key, event_s, event_date, image_group, image_group || '/width', '8', 6
    FROM cam UNION ALL
  SELECT event_key, event_s, event_date, image_group, image_group || '/height', '8', 7
    FROM cam),
payload AS (
  SELECT event_key, event_date, image_group || '/data' AS dataset_name, embedding AS data
  FROM cam)"""

# Pixels of the 8 x 8 frames.
PIXELS = """px AS (
  SELECT vec_id, label, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
pixels AS (SELECT vec_id, label, i, i // 8 AS r, i % 8 AS c, x FROM px)"""


def local_s(text: str) -> str:
    """Epoch seconds of local wall-clock text, in SQL."""
    return f"epoch(timezone('Europe/Zurich', TIMESTAMP '{text}'))::BIGINT"
