"""Typed payload in chunks, and arrays fetched from the event files."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventindex.session import new_path
from eventindex.sources import chunks as CH, containers as SC
from registry import fixtures as fx
from registry.entries import SHOT_CUTS, SHOT_FROM, SHOT_TO
from tests.test_registry import SF, plan

NS = 1526218206135000000


def entry(name, data, shape=None):
    return SC.Entry(name, "/g", {}, {}, None, shape or [len(data)], "", data)


ARRAYS = {
    "/u2": np.array([0, 65535, 7, 40000, 1, 2], "u2"), "/i8": [NS, NS + 1, -2**63, 2**63 - 1],
    "/big": [2**70, 1], "/f4": np.array([0.1, np.nan, -0.0], ">f4"), "/flag": [True, False, True],
    "/text": ["a", "", "ä\n\"", None], "/mixed": [1, "x", 2.5, None], "/bytes": np.array([b"ab", b"c"]),
    "/none": [], "/c16": np.array([1 + 2j])}


@pytest.mark.parametrize("size", [1, 8, 1 << 20])
def test_arrays_come_back_unchanged(size):
    for name, data in ARRAYS.items():
        if name == "/c16":
            continue
        parts = list(CH.pack(entry(name, data), size))
        back = [x for p in parts for x in np.asarray(CH.unpack(p[0], p[5]), object).tolist()]
        want = [x.decode() if isinstance(x, bytes) else x for x in (data.tolist() if isinstance(data, np.ndarray) else data)]
        assert len(back) == len(want)
        for x, y in zip(back, want):
            assert type(x) is type(y) and (x == y or x != x), name
        if isinstance(data, np.ndarray) and data.dtype.kind in "uif":
            assert parts[0][0] == data.dtype.newbyteorder("<").str
        assert [p[2] for p in parts] == list(range(len(parts)))
        rows = [r for p in parts for r in range(p[3], p[4] + 1)]
        assert rows == list(range(len(want)))


def test_chunks_hold_whole_rows():
    data = np.arange(60, dtype="u2")
    parts = list(CH.pack(entry("/x", data, [10, 6]), 30))
    assert [(p[3], p[4]) for p in parts] == [(k, min(k + 1, 9)) for k in range(0, 10, 2)]
    assert all(len(p[5]) == 24 for p in parts)


def test_nothing_is_converted_with_loss():
    assert CH.convert(np.array([2**53], "i8"), "string") == ["9007199254740992"]
    assert CH.convert(np.array([1.0, np.nan]), "double")[0] == 1.0
    assert CH.convert(np.array([3, 4], "u2"), "double").tolist() == [3.0, 4.0]
    assert CH.convert(["a", None], "string") == ["a", None]
    for values, kind in ((np.array([NS], "i8"), "double"), (np.array([1.5]), "bigint"), (["a"], "double"),
                         (np.array([2**63], "u8"), "bigint")):
        with pytest.raises(ValueError):
            CH.convert(values, kind)


@pytest.fixture(scope="module")
def stored(spark):
    path = new_path(spark, "chunks")
    CH.write_chunks(CH.chunk_files(fx.typed_files(spark, SF), fx.decode_typed, chunk_bytes=16), path)
    return CH.read_chunks(spark, path)


def test_a_crop_reads_its_chunks_only(spark, stored):
    frames = stored.where("dataset_name = '/cam/pixels'")
    events = frames.select("event_key").distinct().count()
    assert frames.count() == 3 * events                   # two rows of eight bytes each
    assert frames.where(CH.in_rows(2, 3)).count() == events
    df = CH.frame_rows(frames, 2, 3, kind="bigint")
    text = plan(df)
    pushed = re.search(r"PushedFilters: .*", text)[0]
    assert "LessThanOrEqual(first_row,3)" in pushed and "GreaterThanOrEqual(last_row,2)" in pushed
    assert "/cam/pixels" in pushed and "Exchange" not in text
    rows = df.orderBy("event_key", "row").collect()
    assert len(rows) == 2 * events and [r.row for r in rows[:2]] == [2, 3] and len(rows[0]["values"]) == 4
    whole = CH.frame_rows(frames, kind="bigint")
    assert whole.count() == 6 * events
    assert CH.frame_rows(frames, 2, 3, (1, 1), "bigint").join(
        df.select("event_key", "row", F.col("values").alias("all")), ["event_key", "row"]).where(
        "values[0] <> all[1] OR size(values) <> 1").count() == 0
    assert CH.frame_rows(frames, 9, 20).count() == 0


def test_a_kind_that_would_lose_digits_stops_the_read(stored):
    with pytest.raises(Exception, match="without loss"):
        CH.frame_rows(stored.where("dataset_name = '/cam/stamps'"), kind="double").count()


def test_broken_files_have_no_chunks(spark):
    files = spark.createDataFrame([(f"/a/{NS}_1_1.h5", b"no json"), (f"/a/{NS}_1_2.h5", b'{"x": [1, 2]}')],
                                  "path string, content binary")
    assert [(r.dataset_name, r.dtype) for r in CH.chunk_files(files, SC.decode_json).collect()] == [("/x", "<i8")]


# arrays from the event files

def test_arrays_are_not_shuffled(spark):
    found = fx.located_index(spark, SF).search("", "frames of /CAM3/", SHOT_FROM, SHOT_TO, SHOT_CUTS,
                                               datasets="0", decoder=SC.decode_json)
    text = plan(found)
    arrays = text.index("MapInPandas")
    # in the formatted tree the root comes first: no exchange lies above the step that reads the files
    assert "Exchange" not in text[:arrays]
    assert "data" not in re.findall(r"Output \[\d+\]: \[(.*?)\]", text[arrays:])[0]


def test_missing_files_and_arrays_are_told(spark, tmp_path):
    from eventindex.operators.locate import fetch_entries

    (tmp_path / "a.h5").write_text('{"x": [1, 2], "y": [3, 4], "t": ["p", "q"]}')
    (tmp_path / "b.h5").write_text("broken")
    (tmp_path / "a2.h5").write_text('{"x": [9, 9]}')
    files = spark.createDataFrame([("a", str(tmp_path / "a.h5")), ("a", str(tmp_path / "a2.h5")),
                                   ("b", str(tmp_path / "b.h5")), ("c", str(tmp_path / "c.h5"))],
                                  "event_key string, path string")
    rows = spark.createDataFrame([(k, n, v) for k, n, v in [
        ("a", "/x", None), ("a", "/y", "5"), ("a", "/z", None), ("a", "/t", None), ("b", "/x", None), ("c", "/x", None),
        ("d", "/x", None), ("d", "/y", "1")]], "event_key string, dataset_name string, value string")
    got = {(r.event_key, r.dataset_name): r for r in fetch_entries(rows, files, SC.decode_json, 1).collect()}
    assert len(got) == 8
    assert got["a", "/x"].data == [1.0, 2.0] and got["a", "/x"].missing is None
    assert got["a", "/y"].data is None and got["a", "/y"].missing is None and got["a", "/y"].value == "5"
    assert got["a", "/z"].missing == "no array" and got["a", "/t"].missing == "no array"
    assert "JSON" in got["b", "/x"].missing and "FileNotFound" in got["c", "/x"].missing
    assert got["d", "/x"].missing == "no file" and got["d", "/y"].missing is None
