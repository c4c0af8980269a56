"""Work that must not grow with the number of files: driver lists, tasks, passes and shuffles."""

import io
import random

import pytest
from pyspark.sql import functions as F

from eventindex.operators import locate, select as S
from eventindex.session import task_count
from eventindex.sources import containers as SC, files as SF, records as SR
from registry import fixtures as fx
from tests.test_registry import plan

NS = 1526218206135000000


@pytest.fixture
def tree(tmp_path):
    for name in ("2018/05/13/a.h5", "2018/05/13/deep/b c.h5", "2018/05/14/c.h5", "top.h5", "2018/05/14/c.txt",
                 "_tmp/d.h5", ".hid/e.h5", "2018/_f.h5", "_k=1/g.h5", "Central/h.h5"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode() * 3)
    (tmp_path / "2018" / "06").mkdir()
    return str(tmp_path)


def test_files_are_listed_and_read_by_tasks(spark, tree):
    """The same rows as Spark's reader of files gives, whose list lies in the driver."""
    own = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.h5")
           .load(tree).where("NOT contains(path, '/Central/')"))
    columns = ["path", "modificationTime", "length"]
    scanned, read = SF.scan_files(spark, tree), SF.binary_files(spark, tree)
    assert "binaryFile" not in plan(scanned) + plan(read)
    want = sorted(tuple(r) for r in own.select(*columns, "content").collect())
    assert len(want) == 5
    assert sorted(tuple(r) for r in read.select(*columns, "content").collect()) == want
    assert sorted(tuple(r) for r in scanned.select(*columns).collect()) == [w[:3] for w in want]
    one = SF.scan_files(spark, [f"{tree}/2018/05/1*", f"{tree}/top.h5"])
    assert {r["path"].rsplit("/", 1)[1] for r in one.collect()} == {"a.h5", "b c.h5", "c.h5", "top.h5"}


def test_a_root_that_is_missing_is_an_error(spark, tree):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        SF.scan_files(spark, f"{tree}/nothing")


def many_files(spark, n):
    return spark.range(n).select(F.concat(F.lit(f"/no/{NS}_1_"), "id", F.lit(".h5")).alias("path"),
                                 F.lit(1).cast("bigint").alias("length"), F.col("id").cast("string").alias("event_key"))


def test_tasks_do_not_grow_with_small_files(spark):
    files = many_files(spark, 10_000)
    assert SC.decode_paths(files, SC.decode_json).rdd.getNumPartitions() <= task_count(spark)
    rows = files.select("event_key", F.lit("/a").alias("dataset_name"), F.lit(None).cast("string").alias("value"))
    assert locate.fetch_entries(rows, files, SC.decode_json).rdd.getNumPartitions() <= task_count(spark)


def test_pieces_hold_every_line_once():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choices(["a", "bc", "\n", "\n", "long" * 9], k=rng.randrange(30))).encode()
        size = rng.randrange(1, 20)
        lines = [x for start in range(0, max(1, len(text)), size) for x in SR.piece_lines(io.BytesIO(text), start, size)]
        want = text.split(b"\n")
        assert lines == (want if want[-1] else want[:-1])


def test_event_csvs_are_listed_and_read_by_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbfx,"1\n2"\r\n\ny,3')
    (tmp_path / "b.csv").write_bytes(b"")
    records = SR.quoted_records(spark, str(tmp_path))
    assert "FileScan text" not in plan(records)
    assert sorted((r["record"], r["text"]) for r in records.collect()) == [(0, 'x,"1\n2"'), (1, "y,3")]


def test_lines_are_read_and_dealt_out_once(spark, tmp_path):
    (tmp_path / "lines.txt").write_text('a\nb"\n"c\n\nd\n')
    lines = spark.read.text(str(tmp_path)).select(F.lit("f").alias("path"), F.lit(0).cast("bigint").alias("piece"),
                                                  F.monotonically_increasing_id().alias("line"), "value")
    records = SR.number_records(lines)
    assert sorted((r["record"], r["text"]) for r in records.collect()) == [(0, "a"), (1, 'b"\n"c'), (2, "d")]
    done = records._jdf.queryExecution().executedPlan().toString()
    # the plan that ran, before the one that was planned first
    assert done.split("Initial Plan")[0].count("FileScan text") == 1


def test_event_rows_are_shuffled_once_for_first_values(spark):
    sf = "/root/testdata/sf0.001"
    names = S.first_values(fx.leaf_lines(spark, sf, "event_key"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(names).count("Arguments: hashpartitioning(event_key") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_chunked_files_are_dealt_to_all_tasks(spark):
    assert fx.typed_files(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == task_count(spark)
