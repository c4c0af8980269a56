"""Subtrees found through the dictionary of names."""

import json
import re

import pytest

from eventindex import EventIndex, build_index
from eventindex.operators import groups as G, tree as TR
from eventindex.session import new_path
from eventindex.sources import containers as SC
from tests.test_registry import plan

NAMES = ["/a/x", "/a/b/x", "/a/b/y", "/ab/x", "/c/d/e/x", "/c/y", "/x", "/q-1/x"]


def pairs(spark, names=NAMES):
    return spark.createDataFrame([(n, n.rsplit("/", 1)[0] or "/") for n in names], "dataset_name string, group_name string")


@pytest.mark.parametrize("pattern,match,want", [
    ("/a/b/", "contains", {"/a/b"}), ("a/", "contains", {"/a"}), ("/x", "contains", {"/"}),
    ("e/x|/y$", "regex", {"/a/b", "/c"}), ("^/(a|ab)/", "regex", {"/a", "/ab"}), ("no", "contains", set())])
def test_outermost_groups(spark, pattern, match, want):
    assert {r[0] for r in TR.matched_subtrees(pairs(spark), pattern, match).collect()} == want


def test_ancestors(spark):
    df = pairs(spark, ["/x", "/a/x", "/a/b/c/x"]).select("group_name", TR.ancestors(TR.F.col("group_name")).alias("a"))
    assert {r[0]: r[1] for r in df.collect()} == {"/": [], "/a": ["/"], "/a/b/c": ["/", "/a", "/a/b"]}


def test_many_subtrees_are_joined(spark, monkeypatch):
    df = pairs(spark)
    few = sorted(r[0] for r in TR.in_subtrees(df, pairs(spark), "e/x|/y$", "regex").collect())
    monkeypatch.setattr(TR, "MOST_SUBTREES", 1)
    many = sorted(r[0] for r in TR.in_subtrees(df, pairs(spark), "e/x|/y$", "regex").collect())
    assert few == many == ["/a/b/x", "/a/b/y", "/c/d/e/x", "/c/y"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    root, ns = tmp_path_factory.mktemp("tree"), 1526218206135000000
    day = root / "2018" / "05" / "13"
    day.mkdir(parents=True)
    for k in range(4):
        cam = {"data": [1, 2], "width": k, "more": {"gain": 5}}
        (day / f"{ns + k * 10 ** 9}_1_{k}.h5").write_text(json.dumps(
            {f"cam{k % 2}": {"image": cam}, "cam10": {"image": {"width": 9}}, "other": {"big": 1}}))
    out = new_path(spark, "tree")
    build_index(spark, str(root), out, SC.decode_json)
    return out


@pytest.mark.parametrize("match,pattern", [("contains", "cam1/im"), ("regex", "cam[1]/.*width")])
def test_group_filter_reaches_the_scan(spark, index, match, pattern):
    ix = EventIndex.open(spark, index, match=match)
    rows = G.group_values(**ix._group(pattern, "", "", "", None))
    pushed = re.findall(r"PushedFilters: .*", plan(rows))
    assert any("StringStartsWith(group_name,/cam1/image/)" in p and "EqualTo(group_name,/cam1/image)" in p for p in pushed)
    plain = EventIndex.open(spark, index, match=match)
    plain.groups = None
    both = [sorted(map(str, G.group_values(**x._group(pattern, "", "", "", None)).collect())) for x in (ix, plain)]
    assert both[0] == both[1] and len(both[0]) == 2 * 3
