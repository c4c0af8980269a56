import json
import sys
import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventindex import EventIndex, build_index
from eventindex.session import new_path
from eventindex.sources import (arrays as SA, containers as SC, dictionaries as SD, files as SF,
                                index as SI, manifest as SM)

NS = 1526218206135000000  # 2018-05-13 15:30:06 local time
HOUR = 3600 * 10**9


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    """Six events an hour apart, a malformed name, a broken file, and a Central folder."""
    root = tmp_path_factory.mktemp("tree")
    day = root / "2018" / "05" / "13"
    day.mkdir(parents=True)
    (root / "Central").mkdir()
    (root / "Central" / f"{NS}_0_0.h5").write_text("{}")
    for i in range(6):
        content = {"beam": {"@": {"comment": "beam in mm"}, "charge": i * 10.0, "user": "SFT"},
                   "cam": {"image": {"data": [[i, 2, 3], [4, 5, 6]], "width": 3, "height": 2}}}
        if i == 5:
            del content["beam"]["charge"]
        (day / f"{NS + i * HOUR}_117_{i}.h5").write_text(json.dumps(content))
    (day / "152621820613500000_1_1.h5").write_text("{}")
    (day / f"{NS}_9_9.h5").write_text("not json")
    (day / "notes.txt").write_text("x")
    return str(root)


@pytest.fixture(scope="module")
def index(spark, tree):
    out = new_path(spark, "index")
    build_index(spark, tree, out, SC.decode_json)
    return out


def test_scan_skips_central_and_other_types(spark, tree):
    files = SF.scan_files(spark, tree)
    assert files.count() == 8
    assert "content" not in files.columns
    assert SF.rejected_names(files).count() == 1
    assert SF.events_of(files).count() == 7


def test_built_index(spark, tree, index):
    leaf = SI.read_leaf(spark, f"{index}/leaf")
    assert leaf.count() == 5 * 5 + 4
    row = leaf.where("dataset_name = '/beam/charge'").orderBy("event_key").head()
    assert (row.value, row.value_num, row.group_name, row.comment) \
        == ("0.0", 0.0, "/beam", "beam in mm")
    image = leaf.where("dataset_name = '/cam/image/data'").head()
    assert (image.value, image["shape"], image["size"]) == (None, [2, 3], 6)
    assert spark.read.parquet(f"{index}/rejected_names").count() == 1
    assert "not json" not in spark.read.parquet(f"{index}/undecodable").head().error
    assert spark.read.parquet(f"{index}/undecodable").count() == 1
    stored = SD.read_dictionaries(spark, f"{index}/dictionaries")
    assert {r.dataset_name for r in stored.names.collect()} == {
        "/beam/charge", "/beam/user", "/cam/image/data", "/cam/image/width", "/cam/image/height"}
    # the last dataset in walk order is the one a comment leads to
    assert [tuple(r) for r in stored.comments.collect()] == [("beam in mm", "/beam/user")]
    assert {(r.ref, r.dataset_name, r.value) for r in stored.constants.collect()} == {
        (2, "/beam/user", "SFT"), (3, "/cam/image/data", ""), (4, "/cam/image/height", "2"),
        (5, "/cam/image/width", "3")}


FROM, TO = "2018-05-13 15:30:06", "2018-05-13 20:30:06"  # first and last event, both included


def test_load_column(spark, tree, index):
    ix = EventIndex.open(spark, index, root=tree)
    rows = ix.load_column("beam", "", FROM, TO).orderBy("event_ts").collect()
    assert [r["/beam/charge"] for r in rows] == ["0.0", "10.0", "20.0", "30.0", "40.0", None]
    assert rows[0].path == f"file:{tree}/2018/05/13/{NS}_117_0.h5"
    one = ix.load_column("beam charge", "", FROM, TO, "/beam/charge > 10,/beam/charge < 30",
                         numeric=True).orderBy("event_ts").collect()
    assert [r["/beam/charge"] for r in one] == [10.0, 20.0, 30.0]
    assert spark.read.parquet(f"{index}/decoded/has_data=true").count() == 6
    # an event without the dataset passes its cut
    kept = ix.load_column("user", "", FROM, TO, "/beam/charge > 35").count()
    assert kept == 2
    failing = EventIndex.open(spark, index, root=tree, missing="fail")
    assert failing.load_column("user", "", FROM, TO, "/beam/charge > 35").count() == 1
    strict = EventIndex.open(spark, index, root=tree, strict=True)
    assert strict.load_column("charge", "", FROM, TO, "/beam/charge > 10").count() == 4 - 1
    # listing positions count the undecodable event too, which holds no data
    listed = ix.listing(FROM, TO).orderBy("event_ts", "event_key").collect()
    picked = ix.load_column("charge", "", FROM, TO, events="1,3-4", numeric=True)
    want = {listed[i].event_key for i in (1, 3, 4)}
    assert {r.event_key for r in picked.collect()} == want - {f"{NS}_9_9"}
    assert ix.load_column("nothing like it", "", FROM, TO).count() == 0


def test_picking_datasets(spark, tree, index):
    ix = EventIndex.open(spark, index, root=tree)
    assert ix.resolve("image") == ["/cam/image/data", "/cam/image/height", "/cam/image/width"]
    assert ix.resolve("image", pick="0,2") == ["/cam/image/data", "/cam/image/width"]
    assert ix.resolve("", "IN MM") == ["/beam/user"]
    with pytest.raises(ValueError, match="several"):
        ix.search("image", "", FROM, TO)


def test_search_and_groups(spark, tree, index):
    ix = EventIndex.open(spark, index, root=tree)
    found = ix.search("image data", "", FROM, TO, "/beam/charge < 10").collect()
    events = {r.event_key for r in found}
    assert events == {f"{NS + i * HOUR}_117_{i}" for i in (0, 1, 5)}
    arrays = {r.event_key: r.data for r in found if r.dataset_name == "/cam/image/data"}
    assert arrays[f"{NS}_117_0"] == [0, 2, 3, 4, 5, 6]
    assert all(r.data is None for r in found if r.value is not None)
    meta = ix.load_group_metadata("image data", "", FROM, TO, "/beam/charge == 20").collect()
    # the event with charge 20, and the one that holds no charge
    assert [r.metadata for r in meta] == [
        {"/cam/image/data": None, "/cam/image/height": "2", "/cam/image/width": "3"}] * 2
    assert ix.search("no such", "", FROM, TO).count() == 0
    assert ix.load_group_metadata("no such", "", FROM, TO).count() == 0
    assert ix.rejects(ix.search("image data", "", FROM, TO)).count() == 0
    by_pattern = EventIndex.open(spark, index, root=tree, match="regex")
    again = by_pattern.search("image data", "", FROM, TO, "beam.charge < 10").collect()
    assert {(r.event_key, r.dataset_name, r.value) for r in again} \
        == {(r.event_key, r.dataset_name, r.value) for r in found}


def test_frames(spark, tree, index):
    ix = EventIndex.open(spark, index, root=tree)
    rows = ix.frames("image data", "", FROM, TO, "/beam/charge > 20", events="0-9").collect()
    assert {r.event_key for r in rows} == {f"{NS + i * HOUR}_117_{i}" for i in (2, 3, 4, 5)}
    frame = next(r.frame for r in rows if r.event_key.endswith("_117_3"))
    p = np.pad(np.array([[3, 2, 3], [4, 5, 6]], float), 1)
    assert frame == [[float(np.median(p[r:r + 3, c:c + 3])) for c in range(3)] for r in range(2)]


def test_index_again_merges_dictionaries(spark, tree, index, tmp_path):
    day = tmp_path / "2018" / "05" / "14"
    day.mkdir(parents=True)
    (day / f"{NS + 24 * HOUR}_1_1.h5").write_text(
        json.dumps({"new": {"@": {"comment": "beam in mm"}, "x": 1}}))
    out = new_path(spark, "second")
    build_index(spark, str(tmp_path), out, SC.decode_json, arrays=False, attrs=False,
                merge_with=index)
    stored = SD.read_dictionaries(spark, f"{out}/dictionaries")
    assert stored.names.count() == 6
    assert [tuple(r) for r in stored.comments.collect()] == [("beam in mm", "/new/x")]


def test_rewriting_a_day_keeps_other_days(spark, index):
    leaf = SI.read_leaf(spark, f"{index}/leaf").withColumn(
        "event_date", F.lit("2018-05-20").cast("date"))
    path = new_path(spark, "days")
    for day in ("2018-05-20", "2018-05-21", "2018-05-21"):
        SI.write_leaf(leaf.withColumn("event_date", F.lit(day).cast("date")), path)
    assert SI.read_leaf(spark, path).count() == 2 * leaf.count()


@pytest.mark.parametrize("layout", ["parquet", "csv"])
def test_values_survive_storage(spark, layout):
    rows = [("e", "/a", '"quoted", with comma', [1]), ("e", "/b", None, [2, 3]), ("e", "/c", "", [1]),
            ("e", "/d", "back\\slash", []), ("e", "/e", " two\nlines ", [1]),
            ("e", "/f", "\\N?", [1])]
    leaf = spark.createDataFrame(
        rows, "event_key string, dataset_name string, value string, shape array<int>").withColumns(
        {"event_date": F.lit("2018-05-13").cast("date"),
         "attrs": F.create_map(F.lit("unit"), F.lit("mm"))})
    path = new_path(spark, "values")
    SI.write_leaf(leaf, path, layout)
    back = SI.read_leaf(spark, path, layout)
    assert sorted((r.event_key, r.dataset_name, r.value, r["shape"]) for r in back.collect()) == rows
    assert all(r.attrs == {"unit": "mm"} for r in back.collect())
    SI.write_leaf(leaf, path, layout, attrs=False)
    assert all(r.attrs is None for r in SI.read_leaf(spark, path, layout).collect())


@pytest.mark.parametrize("layout", ["full", "optimized"])
def test_per_event_csv_tree(spark, tmp_path, layout):
    day = tmp_path / "2018" / "5" / "13"
    day.mkdir(parents=True)
    lines = [["/g/b", "/g", "{'comment': 'in, mm'}", "672", "(1,)", "int32"],
             ["/g/a", "/g", "", "", "(512, 672)", "float64"],
             ["/g/b", "/g", "", "7", "(1,)", "int32"],
             ["/g/const", "/g", "5", "", "", ""]]
    headers = SI.CSV_FULL
    if layout == "optimized":
        headers = SI.CSV_OPTIMIZED
        lines = [[x for i, x in enumerate(l) if i != 2] for l in lines[:3]]
    text = "\n".join(",".join('"' + x + '"' if "," in x else x for x in l) for l in [headers, *lines])
    (day / f"{NS}_117_613.csv").write_text(text + "\n")
    rows = SI.read_event_csvs(spark, str(tmp_path), layout).orderBy("seq").collect()
    assert [(r.event_key, r.dataset_name, r.value, r["shape"], r["size"]) for r in rows][:3] == [
        (f"{NS}_117_613", "/g/b", "672", [1], 1),
        (f"{NS}_117_613", "/g/a", None, [512, 672], 344064),
        (f"{NS}_117_613", "/g/b", "7", [1], 1)]
    if layout == "full":
        assert rows[0].attrs == {"comment": "in, mm"} and rows[1].attrs == {}


def test_manifest_with_blanks(spark, tmp_path):
    (tmp_path / "list.txt").write_text("/a/1.h5,/a/2.h5,, ,/a/3.h5,\n")
    got = {r.path for r in SM.read_manifest(spark, str(tmp_path / "list.txt")).collect()}
    assert got == {"/a/1.h5", "/a/2.h5", "/a/3.h5"}


def test_mixed_records_in_dictionary_text(spark):
    line = "{'comment_1': 'in mm,/a\\nno fields\\na,b,c', 'dataset_1': '/a,/b', '/p/x.h5': 'text'}"
    parts = SD.split_mixed(spark.createDataFrame([(line,)], "value string"))
    assert [tuple(r) for r in parts.comments.collect()] == [("in mm", "/a")]
    assert {r.dataset_name for r in parts.names.collect()} == {"/a", "/b"}
    assert [tuple(r) for r in parts.files.collect()] == [("/p/x.h5", "text")]


def test_missing_dictionaries_are_empty(spark, tmp_path):
    stored = SD.read_dictionaries(spark, str(tmp_path / "none"))
    assert [d.count() for d in stored] == [0, 0, 0]


def test_export_skips_existing(spark):
    df = spark.createDataFrame([("a", "2018-05-13", [1.0, 2.5]), ("b", "2018-05-13", [3.0])],
                               "event_key string, event_date string, data array<double>")
    path = new_path(spark, "export")
    SA.export_arrays(df.where("event_key = 'a'"), path)
    SA.export_arrays(df.withColumn("data", F.array(F.lit(9.0))), path)
    got = {r.event_key: r.data for r in SA.read_arrays(spark, path).collect()}
    assert got == {"a": [1.0, 2.5], "b": [9.0]}


def test_hdf5_walk_with_a_stand_in(monkeypatch):
    """The decoder against a stand-in for the HDF5 reader, which is not installed here."""
    class Node:
        def __init__(self, name, parent, attrs=None):
            self.name, self.parent, self.attrs = name, parent, attrs or {}

    class Dataset(Node):
        def __init__(self, name, parent, values, attrs=None):
            super().__init__(name, parent, attrs)
            self.values = np.asarray(values)
            self.size, self.shape, self.dtype = (self.values.size, self.values.shape,
                                                 self.values.dtype)

        def __getitem__(self, key):
            assert key == ()
            return self.values[()]

    class Group(Node):
        def __init__(self, name, parent, attrs=None):
            super().__init__(name, parent, attrs)
            self.members = {}

        def keys(self):
            return list(self.members)

        def __getitem__(self, key):
            found = self.members[key]
            if isinstance(found, Exception):
                raise found
            return found

    class File(Group):
        def __init__(self, handle, mode):
            assert handle.read() == b"bytes" and mode == "r"
            super().__init__("/", None)
            group = self.members["g"] = Group("/g", self, {"comment": b"in mm"})
            group.members = {"one": Dataset("/g/one", group, [672]),
                             "scalar": Dataset("/g/scalar", group, np.float64(1.5), {"acqStamp": 7}),
                             "text": Dataset("/g/text", group, np.array([b"ab"])),
                             "code": Dataset("/g/code", group, np.array([b"A"])),
                             "image": Dataset("/g/image", group, np.arange(6).reshape(2, 3)),
                             "gone": KeyError("broken link"), "around": self}
            self.members["alias"] = group.members["one"]

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

    monkeypatch.setitem(sys.modules, "h5py", types.SimpleNamespace(File=File, Dataset=Dataset))
    every = list(SC.decode_hdf5(b"bytes", True))
    assert [e.dataset_name for e in every if isinstance(e, SC.Fault)] == ["/g/gone", "/g/around"]
    # the alias is found under its own name, in its own group
    assert (every[-1].dataset_name, every[-1].group_name, every[-1].text) == ("/alias", "/", "672")
    some = list(SC.decode_hdf5(b"bytes", True, lambda name: name.endswith("code")))
    assert [e.dataset_name for e in some if e is not None and not isinstance(e, SC.Fault)] == ["/g/code"]
    assert len(some) == len(every)
    got = [e for e in every[:-1] if not isinstance(e, SC.Fault)]
    assert [(e.dataset_name, e.text, e.shape, e.dtype) for e in got] == [
        ("/g/one", "672", [1], "int64"), ("/g/scalar", "1.5", [], "float64"),
        ("/g/text", "ab", [1], "|S2"), ("/g/code", "A", [1], "|S1"),
        ("/g/image", None, [2, 3], "int64")]
    assert got[0].group_attrs == {"comment": "in mm"} and got[1].attrs == {"acqStamp": "7"}
    assert list(got[4].data) == [0, 1, 2, 3, 4, 5] and got[0].data is None
    assert next(e for e in SC.decode_hdf5(b"bytes", False) if not isinstance(e, SC.Fault) and e.shape == [2, 3]).data is None


def test_row_groups_hold_few_datasets(spark):
    """Arrays of 0.8 MB each, decoded in mixed order by one task."""
    import glob
    import pyarrow.parquet as pq

    def entries(content, arrays):
        rng = np.random.default_rng(len(content))
        for name in ("/cam1/image/data", "/cam2/image/data"):
            yield SC.Entry(name, "/g", {}, {}, None, [100_000], "float64", rng.random(100_000))

    files = spark.createDataFrame([(f"/t/{NS + i}_1_{i}.h5", bytes(i + 1)) for i in range(80)],
                                  "path string, content binary").coalesce(1)
    path = new_path(spark, "decoded")
    SC.write_decoded(SC.decode_files(files, entries, arrays=True), path)
    (file,) = glob.glob(path + "/has_data=true/*/*.parquet")
    meta = pq.ParquetFile(file).metadata
    column = meta.schema.to_arrow_schema().names.index("dataset_name")
    stats = [meta.row_group(i).column(column).statistics for i in range(meta.num_row_groups)]
    assert len(stats) >= 3
    assert sum(s.min != s.max for s in stats) <= 1
    got = SC.payload_rows(SC.read_decoded(spark, path)).where("dataset_name LIKE '/cam2%'")
    assert got.selectExpr("sum(size(data))").head()[0] == 80 * 100_000


def test_later_days_leave_earlier_ones(spark, tmp_path):
    out = new_path(spark, "days")
    for d in (13, 14):
        day = tmp_path / f"root{d}" / "2018" / "05" / str(d)
        day.mkdir(parents=True)
        (day / f"{NS + (d - 13) * 24 * HOUR}_1_1.h5").write_text(json.dumps({"a": {"x": d, "y": [1, 2]}}))
        build_index(spark, str(tmp_path / f"root{d}"), out, SC.decode_json)
    build_index(spark, str(tmp_path / "root14"), out, SC.decode_json)
    ix = EventIndex.open(spark, out)
    assert ix.events.count() == 2 and ix.leaf.count() == 4 and ix.payload.count() == 2
    stored = SD.read_dictionaries(spark, f"{out}/dictionaries")
    assert "/a/x" not in [r.dataset_name for r in stored.constants.collect()]
    assert ix.load_column("x").count() == 2


def test_missing_decoder_module_stops_the_job(spark, tree):
    def decoder(content, arrays):
        raise ImportError("no such module")

    with pytest.raises(Exception, match="no such module"):
        SC.decode_files(SF.binary_files(spark, tree), decoder).count()


def test_suffixed_names_are_no_events(spark):
    names = spark.createDataFrame([(f"/a/{NS}_1_1.h5",), (f"/a/{NS}_1_1_copy.h5",)], "path string")
    assert SF.events_of(names).count() == 1 and SF.rejected_names(names).count() == 1


def test_paths_are_those_listed(spark, tmp_path):
    """A prefixed file in a month without zero padding, and an event of a plain and a prefixed file."""
    day = tmp_path / "2018" / "5" / "13"
    day.mkdir(parents=True)
    content = json.dumps({"a": {"x": 1, "y": [1, 2]}})
    (day / f"optimized_{NS}_1_1.h5").write_text(content)
    for prefix in ("", "optimized_"):
        (day / f"{prefix}{NS + HOUR}_1_2.h5").write_text(content)
    out = new_path(spark, "paths")
    build_index(spark, str(tmp_path), out, SC.decode_json)
    ix = EventIndex.open(spark, out, root=str(tmp_path))
    want = {f"file:{day}/optimized_{NS}_1_1.h5", f"file:{day}/{NS + HOUR}_1_2.h5"}
    for found in (ix.load_column("x"), ix.load_wide({"x": "/a/x"}, "", ""), ix.search("a/x"),
                  ix.load_group_metadata("a/x", "", "2018-05-13 00:00:00", "2018-05-13 23:59:59")):
        assert {r.path for r in found.collect()} == want
    # where the path is not asked for, the events are not read
    plan = ix.load_column("x").drop("path")._jdf.queryExecution().optimizedPlan().toString()
    assert "/events" not in plan and "_listed" not in plan
