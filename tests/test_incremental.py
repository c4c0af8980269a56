"""The event-file data source, the ledger and mergeable constants."""

import json
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import datasource as ds, functions as F

from eventindex import EventIndex
from eventindex.operators import constants as CN
from eventindex.plans.build import Changes, read_constants_state, update_index
from eventindex.session import new_path
from eventindex.sources import containers as SC, dictionaries as SD, event_source as ES, index as SI
from tests.test_registry import plan

NS = 1526218206135000000  # 2018-05-13 15:30:06 local time
DAY = 24 * 3600 * 10**9
JSON = "eventindex.sources.containers:decode_json"


def put(root, day, name, content):
    folder = root / "2018" / "05" / str(13 + day)
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{NS + day * DAY + name}_1_{name}.h5"
    path.write_text(content if isinstance(content, str) else json.dumps(content))
    return path


@pytest.fixture
def tree(tmp_path):
    for day in range(3):
        for name in range(5):
            put(tmp_path, day, name, {"a": {"x": 10 * day + name, "same": "s"}, "b": [1, 2, day]})
    (tmp_path / "Central").mkdir()
    (tmp_path / "Central" / f"{NS}_0_0.h5").write_text("{}")
    (tmp_path / "2018" / "13" / "40").mkdir(parents=True)
    return tmp_path


# the data source

decoded_names: list[str] = []
opened: list[int] = []


def counting(content, arrays, wanted=None):
    opened.append(len(content))
    for entry in SC.decode_json(content, arrays, wanted):
        if isinstance(entry, SC.Entry):
            decoded_names.append(entry.dataset_name)
        yield entry


def test_filters_choose_folders_and_datasets(tree):
    """In this process, so that the decoder can count."""
    reader = ES.EventFileReader({"path": str(tree), "decoder": f"{__name__}:counting", "files_per_task": "2"})
    pushed = [ds.GreaterThanOrEqual(("event_date",), date(2018, 5, 14)), ds.EqualTo(("dataset_name",), "/a/x"),
              ds.IsNotNull(("event_date",)), ds.EqualTo(("dtype",), "int64")]
    assert list(reader.pushFilters(pushed)) == pushed     # Spark evaluates all of them again
    parts = reader.partitions()
    assert [(p.day.day, len(p.files)) for p in parts] == [(14, 2), (14, 2), (14, 1), (15, 2), (15, 2), (15, 1)]
    opened.clear(), decoded_names.clear()
    rows = [r for p in parts for batch in reader.read(p) for r in batch.to_pylist()]
    assert len(opened) == 10 and decoded_names == ["/a/x"] * 10
    assert [(r["dataset_name"], r["seq"]) for r in rows] == [("/a/x", 0)] * 10


def test_source_reads_what_decoding_all_reads(spark, tree):
    rows = ES.read_events(spark, str(tree), JSON, arrays=True)
    assert SC.leaf_rows(rows).count() == 45 and SC.payload_rows(rows).count() == 15
    some = rows.where("event_date IN (DATE'2018-05-13', DATE'2018-05-15') AND dataset_name LIKE '/a/%'")
    assert some.count() == 20
    assert some.rdd.getNumPartitions() == 2
    assert rows.where("event_date = DATE'2001-01-01'").count() == 0
    got = {(r.event_key, r.seq): r.text for r in rows.where("dataset_name = '/a/same'").collect()}
    assert len(got) == 15 and set(got.values()) == {"s"}


def test_folder_gives_the_day_and_broken_files_are_reported(spark, tree):
    put(tree, 1, 99, "not json")
    rows = ES.read_events(spark, str(tree), JSON)
    assert SC.undecodable(rows).count() == 1
    assert {str(r[0]) for r in rows.select("event_date").distinct().collect()} == {
        "2018-05-13", "2018-05-14", "2018-05-15"}


def test_one_bad_dataset_leaves_the_others():
    content = json.dumps({"x": 1, "ragged": [[1, 2], [3]], "loop": {"@link": "/"}, "l1": {"@link": "/l2"},
                          "l2": {"@link": "/l1"}, "ok": {"@link": "/x"}}).encode()
    got = list(SC.decode_json(content, True))
    assert [e.dataset_name for e in got if isinstance(e, SC.Fault)] == ["/ragged", "/loop", "/l1", "/l2"]
    assert [(e.dataset_name, e.text) for e in got if isinstance(e, SC.Entry)] == [("/x", "1"), ("/ok", "1")]


# the ledger

def leaf_rows(spark, out):
    return sorted((r.event_key, r.dataset_name, r.value or "") for r in SI.read_leaf(spark, f"{out}/leaf").collect())


def constants(spark, out):
    return {r.dataset_name: r.value for r in SD.read_dictionaries(spark, f"{out}/dictionaries").constants.collect()}


def test_updates_follow_the_tree(spark, tree):
    out, whole = new_path(spark, "led"), new_path(spark, "all")
    args = (SC.decode_json,)
    assert update_index(spark, str(tree), out, *args, end="2018-05-13") == Changes(5, 0)
    assert update_index(spark, str(tree), out, *args, start="2018-05-14") == Changes(10, 0)
    assert update_index(spark, str(tree), out, *args) == Changes(0, 0)
    assert update_index(spark, str(tree), whole, *args) == Changes(15, 0)
    assert leaf_rows(spark, out) == leaf_rows(spark, whole) and len(leaf_rows(spark, out)) == 45
    assert constants(spark, out) == constants(spark, whole) == {"/a/same": "s", "/b": ""}

    # one file changes, one comes, one goes
    put(tree, 1, 3, {"a": {"x": 777, "same": "other"}, "b": [7, 8, 9]})
    put(tree, 2, 50, {"a": {"x": 1, "same": "s"}, "b": [1, 2]})
    os.remove(put(tree, 0, 2, "{}"))
    assert update_index(spark, str(tree), out, *args) == Changes(2, 1)
    again = new_path(spark, "again")
    update_index(spark, str(tree), again, *args)
    assert leaf_rows(spark, out) == leaf_rows(spark, again)
    assert constants(spark, out) == constants(spark, again) == {"/b": ""}
    ix, fresh = EventIndex.open(spark, out), EventIndex.open(spark, again)
    for table in ("payload", "events"):
        rows = [sorted((r.event_key, getattr(r, "data", None)) for r in getattr(x, table).collect()) for x in (ix, fresh)]
        assert rows[0] == rows[1]
    assert [r["/a/x"] for r in ix.load_column("x", "", "2018-05-14 00:00:00", "2018-05-14 23:59:59")
            .orderBy("event_ts").collect()] == ["10", "11", "12", "777", "14"]


def test_a_day_that_is_gone_leaves_nothing(spark, tree):
    out = new_path(spark, "gone")
    update_index(spark, str(tree), out, SC.decode_json)
    for path in (tree / "2018" / "05" / "14").iterdir():
        path.unlink()
    assert update_index(spark, str(tree), out, SC.decode_json) == Changes(0, 5)
    ix = EventIndex.open(spark, out)
    assert ix.events.count() == 10 and ix.leaf.count() == 30 and ix.payload.count() == 10
    assert read_constants_state(spark, out).where("event_date = '2018-05-14'").count() == 0
    assert update_index(spark, str(tree), out, SC.decode_json) == Changes(0, 0)


def test_an_update_that_was_broken_off_is_done_again(spark, tree):
    out = new_path(spark, "broken")
    update_index(spark, str(tree), out, SC.decode_json, end="2018-05-13")
    # the rows of the next day were added, but the ledger was not written
    rows = SC.decode_files(spark.read.format("binaryFile").load(str(tree / "2018" / "05" / "14")), SC.decode_json, True)
    SC.write_decoded(rows, f"{out}/decoded", "append")
    update_index(spark, str(tree), out, SC.decode_json)
    assert len(leaf_rows(spark, out)) == 45 and EventIndex.open(spark, out).payload.count() == 15


# mergeable constants

def state_leaf(spark, rows):
    at = datetime(2018, 5, 13, tzinfo=timezone.utc)
    return spark.createDataFrame([(k, at.replace(hour=h), n, f"/g{k}", v, [1], "f8", 1, s) for k, h, n, v, s in rows],
                                 "event_key string, event_ts timestamp, dataset_name string, group_name string,"
                                 "value string, shape array<int>, dtype string, size bigint, seq bigint")


def test_merged_states_equal_the_state_of_all(spark):
    parts = [state_leaf(spark, [("b", 1, "/same", "v", 4), ("b", 1, "/one", "1", 5), ("b", 1, "/null", None, 6),
                                ("c", 2, "/varies", "1", 1), ("d", 2, "/varies", "2", 1)]),
             state_leaf(spark, [("a", 1, "/same", "v", 9), ("a", 1, "/one", "2", 1), ("a", 3, "/null", "", 1),
                                ("a", 1, "/new", "n", 2)])]
    both = CN.constant_state(parts[0].unionByName(parts[1]))
    merged = CN.merge_states(CN.constant_state(parts[0]).unionByName(CN.constant_state(parts[1])))

    def rows(state):
        return sorted(tuple(r) for r in CN.constants_of(state).collect())
    assert rows(merged) == rows(both)
    assert [r[:3] for r in rows(merged)] == [("/new", "/ga", "n"), ("/null", "/gb", ""), ("/same", "/ga", "v")]
    assert {r.dataset_name: r.n for r in merged.collect()} == {"/same": 2, "/one": 2, "/null": 2, "/varies": 2, "/new": 1}


def test_constants_are_found_by_hash_aggregation(spark):
    df = CN.constants_of(CN.constant_state(state_leaf(spark, [("a", 1, "/x", "1", 1)])))
    text = plan(df)
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text
    merged = plan(CN.constants_of(CN.merge_states(CN.constant_state(state_leaf(spark, [("a", 1, "/x", "1", 1)])))))
    assert "SortAggregate" not in merged and "SinglePartition" not in merged
