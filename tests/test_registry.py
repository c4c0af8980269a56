"""Every registered query against its SQL, and the shape of the plans."""

import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from eventindex.operators import groups as G, ordinals as O, select as S
from eventindex.plans.api import EventIndex
from eventindex.session import new_path
from eventindex.sources import index as SI
from registry import fixtures as fx
from registry.compare import difference, duck
from registry.entries import ENTRIES, LINE_CUTS, LINE_FROM, LINE_TO, SHOT_CUTS, SHOT_FROM, SHOT_TO

SF = "/root/testdata/sf0.001"
BOUNDED_WINDOW = ("select_ordinals", "select_names", "slice_events", "backref_encode",
                  "backref_decode")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("key", list(ENTRIES))
def test_matches_sql(spark, con, key):
    df = ENTRIES[key].run(spark, SF)
    problem = difference(df, con, ENTRIES[key].sql)
    # at this size every customer has orders of several statuses, so nothing is constant
    assert problem is None or (key in ("constants", "merge_constants") and problem == "no rows")
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # nothing but the bounded windows of ordinals is brought into a single partition
    assert key in BOUNDED_WINDOW or "SinglePartition" not in text


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(ENTRIES) <= set(driver.queries())
    if driver.llm is None and driver.corpus_pipeline is None:
        assert set(ENTRIES) == set(driver.queries())
    assert driver.entry(spark).count() > 0


@pytest.fixture(scope="module")
def stored(spark):
    path = new_path(spark, "stored")
    SI.write_leaf(fx.leaf_shots(spark, SF), path)
    return SI.read_leaf(spark, path)


def stored_index(spark, leaf):
    ix = fx.shots_index(spark, SF)
    return EventIndex(ix.events, leaf, ix.names, ix.comments, ix.payload, fx.ROOT)


def test_columns_and_cuts_share_one_shuffle(spark, stored):
    df = stored_index(spark, stored).load_column(
        "streak camera exposure", "", SHOT_FROM, SHOT_TO, SHOT_CUTS).drop("path")
    text = plan(df)
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
    filters = re.search(r"PartitionFilters: .*", text)[0]
    assert "event_date" in filters and "2024-01-25" in filters
    pushed = re.search(r"PushedFilters: .*", text)[0]
    assert "dataset_name" in pushed and "/streak/camera/exposure" in pushed and "event_ts" in pushed
    schema = re.search(r"ReadSchema: .*", text)[0]
    assert "attrs" not in schema and "comment" not in schema and "shape" not in schema


def test_stored_times_have_statistics(stored):
    import pyarrow.parquet as pq

    meta = pq.ParquetFile(stored.inputFiles()[0].removeprefix("file://")).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    for name in ("event_ts", "dataset_name", "group_name"):
        assert columns[name].statistics.has_min_max, name
    assert columns["event_ts"].physical_type == "INT64"


def test_numeric_columns_aggregate_by_hash(spark):
    text = plan(fx.lines_index(spark, SF).load_column(
        "line1 quantity", "", LINE_FROM, LINE_TO, LINE_CUTS, numeric=True))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_group_load_reads_only_its_group(spark, stored):
    text = plan(stored_index(spark, stored).load_group_metadata(
        "cam3 image data", "", SHOT_FROM, SHOT_TO, SHOT_CUTS))
    pushed = re.findall(r"PushedFilters: .*", text)
    assert any("StringStartsWith(group_name,/cam3/image/)" in p for p in pushed)
    assert any("/cam3/image/data" in p and "/beam/source/intensity" in p for p in pushed)


def test_event_selection_numbers_without_sorting_in_one_task(spark):
    listing = S.time_range(fx.events(spark, SF), SHOT_FROM, SHOT_TO)
    text = plan(O.select_ordinals(listing.select("event_ts", "event_key"), "0-50"))
    # numbered hour by hour, and only in the hours that hold the positions
    assert "SinglePartition" not in text and "row_number" in text and "_start" in text


def test_stored_index_gives_the_same_answers(spark, stored):
    direct, kept = fx.shots_index(spark, SF), stored_index(spark, stored)

    def rows(ix):
        found = ix.search("", "frames of /cam3/", SHOT_FROM, SHOT_TO, SHOT_CUTS, "0", "0-400")
        return sorted(map(str, found.select("event_key", "dataset_name", "value", "data").collect()))

    assert rows(direct) == rows(kept) != []


def test_workers_need_not_run_in_this_folder(tmp_path):
    """A driver in another folder, in another time zone, that knows this file's path only."""
    root = driver.__file__
    script = tmp_path / "drive.py"
    script.write_text(f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry_file", {root!r})
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.session.timeZone", "America/New_York").getOrCreate())
run = module.queries()["median3x3"]
print("pixels", run(spark, {SF!r}).agg({{"x": "sum"}}).count(), run(spark, {SF!r}).count())
""")
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True,
                          text=True, timeout=300,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "pixels 1 32000" in done.stdout, done.stderr[-2000:]


def test_hot_event_and_hot_dataset(spark, con):
    """A third of all rows in one event, and in one dataset: same answers, no long task list."""
    lines = fx.leaf_lines(spark, SF)
    hot = lines.withColumn("event_key", F.when(F.col("seq") % 3 == 0, "hot")
                           .otherwise(F.col("event_key"))).withColumn(
        "event_ts", F.when(F.col("event_key") == "hot", F.lit("1997-01-01").cast("timestamp"))
        .otherwise(F.col("event_ts")))
    first = S.first_values(hot, "value_num")
    want = {}
    for r in hot.select("event_key", "dataset_name", "value_num", "seq").collect():
        k = (r.event_key, r.dataset_name)
        want[k] = min(want.get(k, (r.seq, r.value_num)), (r.seq, r.value_num))
    got = {(r.event_key, r.dataset_name): r.value_num for r in first.collect()}
    assert got == {k: v[1] for k, v in want.items()}


def test_peak_frequencies(spark, make_leaf):
    import numpy as np

    rng = np.random.default_rng(3)
    images = rng.normal(size=(4, 16, 8))
    axis = [i * 2.5 for i in range(16)] + [0.0]
    rows = [r for i in range(4) for r in ((f"e{i}", "/s/image", None), (f"e{i}", "/s/axis", None),
                                          (f"e{i}", "/s/charge", str(i)))]
    arrays = [(f"e{i}", n, d) for i in range(4)
              for n, d in (("/s/image", images[i].ravel().tolist()), ("/s/axis", axis))]
    payload = spark.createDataFrame(
        arrays, "event_key string, dataset_name string, data array<double>").withColumn(
        "event_date", F.lit("2018-05-13").cast("date"))
    ix = EventIndex(None, make_leaf(rows), None, None, payload)
    got = ix.peak_frequencies("/s/image", "/s/axis", 8, 16, "2018-05-13 00:00:00",
                              "2018-05-13 23:59:59", "/s/charge > 1").collect()
    assert {r.event_key for r in got} == {"e1", "e2", "e3"}
    for r in got:
        p = images[int(r.event_key[1])].mean(axis=1)
        amplitudes = np.abs(np.fft.fft(p - p.mean()))
        assert np.isclose(r.max_amplitude, amplitudes.max())
        assert r.peak_bin in (amplitudes.argmax(), 16 - amplitudes.argmax())
        assert np.isclose(r.max_frequency, r.peak_bin * 1e3 / 37.5)


def test_a_hot_event_is_split_in_group_joins(spark):
    """A third of all rows in one event. The thresholds are lowered to the size of the test data,
    and broadcasts switched off, as they would be for a large side."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
                "spark.sql.shuffle.partitions": "16"}
    lines = fx.leaf_lines(spark, SF)
    hot = F.col("seq") % 3 == 0
    leaf = lines.withColumns({
        "event_key": F.when(hot, "hot").otherwise(F.col("event_key")),
        "event_ts": F.lit(0).cast("timestamp"), "event_date": F.lit("1970-01-01").cast("date")})
    plain = sorted(map(str, G.group_values(leaf, "/line2/tax").collect()))
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = G.group_values(leaf, "/line2/tax")
        assert sorted(map(str, df.collect())) == plain
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
