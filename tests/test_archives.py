"""Archives of event files: an event takes no file of its own, and is listed and read as if it had one."""

import json
import os
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import datasource as ds

from eventindex.functions import names as N
from eventindex.operators import locate
from eventindex.plans.build import Changes, update_index
from eventindex.session import new_path, task_count
from eventindex.sources import containers as SC, event_source as ES, files as SF
from registry import fixtures as fx
from registry.entries import ENTRIES

NS = 1526218206135000000  # 2018-05-13 15:30:06 local time
JSON = "eventindex.sources.containers:decode_json"


def key(n):
    return f"{NS}_117_{n}"


def content(n):
    return json.dumps({"beam": {"charge": n, "pair": [n, 2]}})


@pytest.fixture
def tree(tmp_path):
    """Three files in a folder, five in an archive, and what is no event file."""
    day = tmp_path / "2018" / "05" / "13"
    day.mkdir(parents=True)
    (tmp_path / "Central").mkdir()
    for n in range(3):
        (day / f"{key(n)}.h5").write_text(content(n))
    with zipfile.ZipFile(day / "many.h5.zip", "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr(f"{key(3)}.h5", "{}")
        for n in (4, 5):
            out.writestr(f"{key(n)}.h5", content(n))
        out.mkdir("deep er")
        out.writestr(f"deep er/{key(6)}.h5", content(6))
        out.writestr(f"optimized_{key(7)}.h5", "")
        for name in ("notes.txt", f"_{key(8)}.h5", f"__MACOSX/{key(8)}.h5", f"Central/{key(8)}.h5", "x.h5.zip"):
            out.writestr(name, content(8))
        with pytest.warns(UserWarning):  # written again: the last counts
            out.writestr(f"{key(3)}.h5", content(3))
    with zipfile.ZipFile(tmp_path / "Central" / "c.h5.zip", "w") as out:
        out.writestr(f"{key(9)}.h5", content(9))
    with zipfile.ZipFile(day / "other.zip", "w") as out:
        out.writestr(f"{key(9)}.h5", content(9))
    return tmp_path


def test_files_of_an_archive_are_listed_and_read(spark, tree):
    archive = tree / "2018" / "05" / "13" / "many.h5.zip"
    for root in (str(tree), [str(tree / "2018" / "05" / "13" / "*.h5"), str(archive)]):
        rows = SF.binary_files(spark, root).orderBy(N.stem(F.col("path"))).collect()
        assert [r.path.rsplit("/", 1)[1] for r in rows] == [*[f"{key(n)}.h5" for n in range(7)], f"optimized_{key(7)}.h5"]
        assert [bytes(r.content).decode() for r in rows] == [*[content(n) for n in range(7)], ""]
        assert [r.length for r in rows] == [len(r.content) for r in rows]
        listed = SF.scan_files(spark, root)
        assert sorted(map(tuple, listed.collect())) == sorted((r.path, r.length, r.modificationTime) for r in rows)
    assert rows[6].path == f"file:{archive}!/deep er/{key(6)}.h5"
    assert int(rows[6].modificationTime.timestamp() * 1000) == archive.stat().st_mtime_ns // 10**6
    assert SF.events_of(listed).select("event_key").distinct().count() == 8
    days = listed.select(N.path_fields(F.col("path"))["path_date"].alias("day")).where("day IS NOT NULL")
    assert days.count() == 7  # all but the one in a folder of the archive
    # other lists of files leave archives alone
    assert SF.listed_files(spark, str(tree), "*.h5").count() == 3


def test_the_source_reads_archives_as_portions(spark, tree):
    reader = ES.EventFileReader({"path": str(tree), "decoder": JSON, "files_per_task": "2"})
    list(reader.pushFilters([ds.EqualTo(("event_date",), date(2018, 5, 13))]))
    assert [[os.path.basename(f) for f in p.files] for p in reader.partitions()] == [
        [f"{key(0)}.h5", f"{key(1)}.h5"], [f"{key(2)}.h5"], ["many.h5.zip"]]
    rows = ES.read_events(spark, str(tree), JSON, arrays=True)
    got = {r.event_key: r.text for r in SC.leaf_rows(rows.where("dataset_name = '/beam/charge'"))
           .select("event_key", F.col("value").alias("text")).collect()}
    # the source lists all of a day's folder, as it does for folders of files
    assert got == {key(n): str(n) for n in (*range(7), 8)}
    assert SC.payload_rows(rows).count() == 8
    assert SC.undecodable(rows).count() == 1


def test_broken_archives_and_files_in_them_are_reported(spark, tree):
    day = tree / "2018" / "05" / "13"
    packed = (day / "many.h5.zip").read_bytes()
    at = packed.index(f"{key(5)}.h5".encode()) + len(f"{key(5)}.h5")
    (day / "many.h5.zip").write_bytes(packed[:at] + bytes(8) + packed[at + 8:])
    (day / "none.h5.zip").write_text("x")
    files = SF.scan_files(spark, str(tree))
    assert [r.path.rsplit("/", 1)[1] for r in SF.rejected_names(files).collect()] == ["none.h5.zip"]
    whole = SC.decode_files(SF.binary_files(spark, str(tree)), SC.decode_json)
    for decoded in (whole, SC.decode_paths(files, SC.decode_json), ES.read_events(spark, str(tree), JSON)):
        faults = {r.path.rsplit("/", 1)[1] for r in SC.undecodable(decoded).collect()}
        assert faults == {f"{key(5)}.h5", f"optimized_{key(7)}.h5", "none.h5.zip"}
        held = {r.event_key for r in SC.leaf_rows(decoded).collect()}
        assert held >= {key(n) for n in (0, 1, 2, 3, 4, 6)} and key(5) not in held


def test_updates_and_fetched_arrays_of_archives(spark, tree):
    out = new_path(spark, "packed")
    assert update_index(spark, str(tree), out, SC.decode_json) == Changes(8, 0)
    assert update_index(spark, str(tree), out, SC.decode_json) == Changes(0, 0)
    with zipfile.ZipFile(tree / "2018" / "05" / "13" / "more.h5.zip", "w") as more:
        more.writestr(f"{key(20)}.h5", content(20))
    os.remove(tree / "2018" / "05" / "13" / f"{key(0)}.h5")
    assert update_index(spark, str(tree), out, SC.decode_json) == Changes(1, 1)
    files = SF.events_of(SF.scan_files(spark, str(tree)))
    rows = files.select("event_key", F.lit("/beam/pair").alias("dataset_name"), F.lit(None).cast("string").alias("value"))
    got = {r.event_key: r.data for r in locate.fetch_entries(rows, files, SC.decode_json).collect()}
    assert got == {key(n): [n, 2.0] for n in (*range(1, 7), 20)} | {key(7): None}


def test_files_on_disk_do_not_grow_with_events(spark, tmp_path):
    """Ten thousand events of five days, some of them twice."""
    rows = spark.range(10_000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-02 12:00:00' + make_interval(0, 0, 0, cast(id % 5 AS int)) AS ts",
        "id % 7 AS user_id", "if(id % 3 = 0, 'view', 'error') AS event_type", "id / 4D AS value", "'{}' AS props")
    rows.unionAll(rows.where("event_id < 100")).write.parquet(str(tmp_path / "events.parquet"))
    sf = str(tmp_path)
    root = fx.container_tree(spark, sf).removeprefix("file:")
    on_disk = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith((".h5", ".zip"))]
    assert len(on_disk) <= 5 + 5 + 10 + task_count(spark)  # Central, ends of days, full archives, ends of ranges
    assert sum(os.path.getsize(f) for f in on_disk) < 10_000 * 300
    for packed in on_disk:
        if packed.endswith(".zip"):
            names = zipfile.ZipFile(packed).namelist()
            assert len(names) == len(set(names)) <= fx.ARCHIVE_FILES
    scanned = ENTRIES["scan_files"].run(spark, sf)
    assert scanned.count() == scanned.select("stem").distinct().count() == 10_000
    assert scanned.where("filled = 'yes' AND event_s IS NOT NULL").count() == 10_000
    read = ENTRIES["event_source"].run(spark, sf)
    want = {(f"{r.event_id}", str(r.value), str(r.day)) for r in rows.selectExpr("event_id", "value", "to_date(ts) AS day")
            .where("day BETWEEN DATE'2024-01-03' AND DATE'2024-01-04'").collect()}
    assert len(want) == 4_000
    assert sorted((r.event_key.split("_")[2], r.value, r.day) for r in read.collect()) == sorted(want)


def test_stems_are_those_of_the_whole_path(spark):
    paths = ["a/b.c/d.e.f", "/x/", "", "x", ".hid", "a/.hid.h5", "a/..b", "a\n/b\n", "a/\n", "a/b.c\n", "/", "a.b/c", None]
    rows = spark.createDataFrame([(p,) for p in paths], "path string")
    for r in rows.select(N.stem(F.col("path")).alias("own"), F.regexp_extract("path", N.STEM, 1).alias("whole")).collect():
        assert r.own == r.whole
