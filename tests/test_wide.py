"""Pivot to many columns."""

import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from eventindex.operators import select as S, wide as W
from registry import fixtures as fx
from registry.entries import ENTRIES, LINE_CUTS, LINE_FROM, LINE_TO
from tests.test_registry import SF, plan


def leaf_of(spark, rows):
    at = datetime(2018, 5, 13, tzinfo=timezone.utc)
    return spark.createDataFrame([(e, at, date(2018, 5, 13), d, v, None, s) for e, d, v, s in rows],
                                 "event_key string, event_ts timestamp, event_date date, dataset_name string,"
                                 "value string, value_num double, seq bigint")


def test_equal_to_the_plain_pivot(spark):
    rng = random.Random(4)
    rows = [(f"e{rng.randrange(40)}", f"/d{rng.randrange(60)}", rng.choice(["a", "b", None, ""]), k) for k in range(3_000)]
    leaf, names = leaf_of(spark, rows), {f"c{i}": f"/d{i}" for i in range(0, 70, 2)}
    got = sorted(map(tuple, W.pivot_wide(leaf, names).collect()))
    want = sorted(map(tuple, S.pivot_columns(leaf, names).select(*S.EVENT, *names).collect()))
    assert str(got) == str(want) and len(got) == 40


def test_a_hot_event_is_combined_first(spark):
    leaf = leaf_of(spark, [("hot", f"/d{k % 3}", str(k), k) for k in range(5_000)] + [("e", "/d1", "x", 1), ("none", "/z", "x", 1)])
    df = W.pivot_wide(leaf, {"b": "/d1", "a": "/d0", "z": "/d9"})
    assert {r["event_key"]: (r["b"], r["a"], r["z"]) for r in df.collect()} == {"hot": ("1", "0", None), "e": ("x", None, None)}
    assert plan(df).count("Exchange") >= 2 and "CartesianProduct" not in plan(df)


def test_thousands_of_columns(spark, monkeypatch):
    names = {f"c{i}": f"/d{i}" for i in range(3_000)}
    leaf = leaf_of(spark, [("a", "/d17", "x", 1), ("a", "/d2999", "y", 2), ("b", "/d0", "z", 1)])
    rows = {r["event_key"]: r for r in W.pivot_wide(leaf, names).collect()}
    assert rows["a"]["c17"] == "x" and rows["a"]["c2999"] == "y" and rows["b"]["c0"] == "z"
    assert sum(v is not None for v in rows["a"][3:]) == 2
    assert W.pivot_wide(leaf.limit(0), names).count() == 0
    with pytest.raises(ValueError):
        W.pivot_wide(leaf, {"a": "/x", "b": "/x"})


def test_load_wide_equals_load_named(spark):
    ix = fx.lines_index(spark, SF)
    names = {"q": "/line1/quantity", "t": "/line3/tax"}
    args = (names, LINE_FROM, LINE_TO, LINE_CUTS)
    for numeric in (False, True):
        got = sorted(map(str, ix.load_wide(*args, numeric=numeric).collect()))
        assert got == sorted(map(str, ix.load_named(*args, numeric=numeric).collect())) != []


def cells_of(df):
    return {r["event_key"]: [tuple(c) for c in r["cells"]] for r in df.collect()}


def test_a_list_as_a_table_equals_the_plain_pivot(spark):
    rng = random.Random(4)
    rows = [(f"e{rng.randrange(40)}", f"/d{rng.randrange(60)}", rng.choice(["a", "b", None, ""]), k) for k in range(1_000)]
    leaf, names = leaf_of(spark, [*rows, ("none", "/z", "x", 1)]), {f"c{i}": f"/d{i}" for i in range(0, 70, 2)}
    listed = spark.createDataFrame([(i, f"/d{i}") for i in range(0, 70, 2)], "column int, dataset_name string")
    got = cells_of(W.pivot_wide(leaf, listed))
    want = {r["event_key"]: [(i, r[f"c{i}"]) for i in range(0, 70, 2)] for r in S.pivot_columns(leaf, names).collect()}
    held = {(e, d) for e, d, _, _ in rows}
    assert got == {e: [(i, v) for i, v in row if (e, f"/d{i}") in held] for e, row in want.items()} and len(got) == 40


def test_a_list_with_repeated_and_missing_rows(spark):
    listed = spark.createDataFrame([("b", "/d1"), ("a", "/d0"), ("b", "/d1"), ("c", None), ("y", "/d9")],
                                   "column string, dataset_name string")
    leaf = leaf_of(spark, [("e", "/d1", "x", 2), ("e", "/d1", "late", 3), ("e", "/d0", None, 1), (None, "/d0", "n", 1),
                           ("e", None, "no", 1)])
    df = W.pivot_wide(leaf, listed)
    assert cells_of(df) == {"e": [("a", None), ("b", "x"), ("b", "x")], None: [("a", "n")]}
    one = df.select("event_key", *[W.cell(c).alias(c) for c in "aby"]).collect()
    assert {tuple(r) for r in one} == {("e", None, "x", None), (None, "n", None, None)}


def test_a_list_of_any_length_stays_out_of_the_driver(spark):
    listed = spark.range(300_000).select(F.col("id").alias("column"), F.concat(F.lit("/d"), "id").alias("dataset_name"))
    df = W.pivot_wide(leaf_of(spark, [("a", "/d299999", "y", 2), ("a", "/d7", "x", 1), ("b", "/d300000", "z", 1)]), listed)
    assert cells_of(df) == {"a": [(7, "x"), (299_999, "y")]}
    assert df.columns == [*S.EVENT, "cells"] and "Broadcast" not in plan(df)


def test_wide_pivot_takes_its_parts_as_a_table(spark, tmp_path, monkeypatch):
    spark.range(1_000).select(F.col("id").alias("p_partkey")).write.parquet(str(tmp_path / "part.parquet"))
    lines = [(1, 1, 7, 5, 2.0), (1, 2, 7, 5, 3.0), (2, 1, 150, 5, 4.5), (2, 1, 999, 6, None), (3, 1, 1_000, 6, 9.0)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    df = spark.range(1)
    with monkeypatch.context() as m:
        for name in ("collect", "toPandas", "toLocalIterator", "toArrow"):
            m.setattr(type(df), name, lambda *_: pytest.fail("the parts are brought into the driver"))
        df = ENTRIES["wide_pivot"].run(spark, str(tmp_path))
    assert {tuple(r) for r in df.collect()} == {("sup5", 2, 6.5, 2.0, 4.5, None), ("sup6", 0, 0.0, None, None, None)}
    assert "Broadcast" not in plan(df)
