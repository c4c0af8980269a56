"""CSV records with quoted line breaks, over many pieces of a file."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from eventindex.session import new_path
from eventindex.sources import index as SI, records as SR

NS = 1526218206135000000


def random_records(rng, n):
    signs = ["a", "b", ",", '"', "\n", '""', "\n\n", " ", "ä"]
    return [["".join(rng.choices(signs, k=rng.randrange(6))) for _ in range(3)] for _ in range(n)]


def text_of(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("pieces", [1, 3, 40])
def test_pieces_join_to_the_records(spark, pieces):
    rng = random.Random(pieces)
    rows, want = [], {}
    for file in ("f1", "f2", "f3"):
        want[file] = random_records(rng, 60)
        lines = text_of(want[file]).split("\n")
        rows += [(file, i * pieces // len(lines), i, line) for i, line in enumerate(lines)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "path string, piece long, line long, value string")
    got: dict = {}
    for r in SR.number_records(df).collect():
        got[r["path"], r["record"]] = next(csv.reader(io.StringIO(r["text"], newline="")))
    assert got == {(f, k): row for f, rows in want.items() for k, row in enumerate(rows)}


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    rng = random.Random(3)
    want = [[str(k), *r[:2]] for k, r in enumerate(random_records(rng, 30_000))]
    (tmp_path / "big.csv").write_text("k,x,y\n" + text_of(want))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        records = SR.quoted_records(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path / "big.csv")).rdd.getNumPartitions() > 4
        rows = SR.parse_records(records, SI._texts(["k", "x", "y"]), {**SI.CSV_QUOTED, "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
                                                                      "ignoreTrailingWhiteSpace": "false"})
        got = {int(r["k"]): [r["k"], r["x"], r["y"]] for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == len(want)
    # an empty field is NULL
    assert [got[k] for k in range(len(want))] == [[x or None for x in row] for row in want]


def test_layouts_and_references(spark, tmp_path):
    day = tmp_path / "2018" / "05" / "13"
    day.mkdir(parents=True)
    (day / f"{NS}_1_1.csv").write_text("DatasetName,GroupName,DatasetValue,Shape,Datatype\r\n"
                                       '/g/a,/g,7,"(1,)",int64\r\n/g/b,/g,2,,\r\n/g/c,/g,2,,\r\n')
    (tmp_path / "Central").mkdir()
    central = tmp_path / "Central" / "CentralCSV.csv"
    central.write_text('DatasetName,GroupName,DatasetValue,Shape,Datatype\n/g/b,/g,"5, 6","(1,)",object\n')
    rows = {r["dataset_name"]: r for r in SI.read_event_csvs(spark, str(tmp_path), "optimized", str(central)).collect()}
    assert (rows["/g/a"]["value"], rows["/g/a"]["value_num"], rows["/g/a"]["seq"]) == ("7", 7.0, 1)
    assert (rows["/g/b"]["value"], rows["/g/b"]["dtype"], rows["/g/b"]["value_num"]) == ("5, 6", "object", None)
    # the number belongs to another dataset: no value, and never the number itself
    assert rows["/g/c"]["value"] is None and rows["/g/c"]["value_num"] is None
    plain = {r["dataset_name"]: r["value"] for r in SI.read_event_csvs(spark, str(tmp_path), "optimized").collect()}
    assert plain == {"/g/a": "7", "/g/b": None, "/g/c": None}
