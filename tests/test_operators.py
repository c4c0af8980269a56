import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from eventindex.operators import (cuts as C, dictionaries as D, flatten as FL, groups as G,
                                  ordinals as O, payload as P, select as S)


# --- ordinals ----------------------------------------------------------------------------

@pytest.mark.parametrize("spec, want", [
    ("7", [7]), ("1,3,9", [1, 3, 9]), ("0-3", [0, 1, 2, 3]), ("1,5-7", [1, 5, 6, 7]),
    (" 2 , 4 - 5 ", [2, 4, 5]), ("5-3", [])])
def test_ordinal_forms(spec, want):
    assert [i for lo, hi in O.parse_ordinals(spec) for i in range(lo, hi + 1)] == want


@pytest.mark.parametrize("spec", ["", "a", "1;2", "-3", "1,,2"])
def test_bad_ordinals(spec):
    with pytest.raises(ValueError):
        O.parse_ordinals(spec)


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=6))
def test_ordinal_ranges_are_exact_sorted_and_disjoint(pairs):
    ranges = O.parse_ordinals(",".join(f"{a}-{b}" for a, b in pairs))
    got = [i for lo, hi in ranges for i in range(lo, hi + 1)]
    assert got == sorted({i for a, b in pairs for i in range(a, b + 1)})


def test_positions_among_ties(spark):
    # a third of the rows share one time, and ties are broken by the key
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise((F.col("id") * 7919) % 1000)
        .cast("timestamp").alias("event_ts"),
        F.lpad(((F.col("id") * 104729) % 3001).cast("string"), 5, "0").alias("event_key"))
    want = sorted((r.event_ts, r.event_key) for r in df.collect())
    for spec, n in (("0-10,1000-1005", 17), ("5,2500-2999", 501)):
        rows = O.select_ordinals(df, spec).collect()
        assert len(rows) == n
        assert all(want[r.ordinal] == (r.event_ts, r.event_key) for r in rows)
    assert [r.ref for r in O.with_ordinals(df, name="ref", first=2).orderBy("ref").collect()] \
        == list(range(2, 3002))


def test_positions_past_the_end_match_nothing(spark):
    df = spark.range(3).select(F.timestamp_seconds("id").alias("event_ts"),
                               F.col("id").cast("string").alias("event_key"))
    assert O.select_ordinals(df, "2-9").count() == 1
    assert O.select_ordinals(df, "5-3").count() == 0
    assert [r.event_key for r in O.slice_rows(df, 1, 3).orderBy("event_key").collect()] == ["1", "2"]


# --- cuts --------------------------------------------------------------------------------

def test_parse_cuts():
    assert C.parse_cuts("/a/b < 100.0,/a/b > 1.0") == [C.Cut("/a/b", "<", 100.0),
                                                        C.Cut("/a/b", ">", 1.0)]
    assert C.parse_cuts("") == [] and len(C.parse_cuts("/a == 3")) == 1


@pytest.mark.parametrize("text", ["/a <", "/a <= 3", "/a < x", "/a < 1,", "/a 1 <"])
def test_malformed_cuts_are_errors(text):
    with pytest.raises(ValueError):
        C.parse_cuts(text)


def test_cut_text_in_a_column_follows_the_same_rules(spark):
    texts = ["/a/b < 100.0,/a/b > 1", "/a==3", "/a == 3", "/a <= 3,/b > x", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = C.cut_rows(df, "text", "id").orderBy("id", "cut_id").collect()
    good = {}
    for r in rows:
        if r.op is not None:
            good.setdefault(r.id, []).append(C.Cut(r.dataset_name, r.op, r.bound))
    assert good == {0: C.parse_cuts(texts[0]), 2: C.parse_cuts(texts[2])}
    assert [r.id for r in rows if r.op is None] == [1, 3, 3]


def expected(value, op, bound, strict, missing):
    """What a cut says about the first value: absent, text, missing number, or a number."""
    if value in ("absent", "text"):
        return missing != "fail"
    v = math.nan if value is None else value
    if op == "==":
        return v == bound
    if math.isnan(v) or math.isnan(bound):
        return True
    if op == "<":
        return v < bound if strict else v <= bound
    return v > bound if strict else v >= bound


VALUES = ["absent", "text", None, math.nan, -1.0, 0.0, 2.5, 3.0]


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("missing", ["pass", "fail"])
def test_cut_semantics(make_leaf, strict, missing):
    rows = []
    for i, v in enumerate(VALUES):
        rows.append((f"e{i}", "/other", "1"))
        if v != "absent":
            rows.append((f"e{i}", "/x", None if v is None else str(v)))
            rows.append((f"e{i}", "/x", "2.5"))  # a later value never counts
    leaf = make_leaf(rows).cache()
    events = leaf.select("event_key").distinct()
    for op in C.OPERATORS:
        for bound in (2.5, math.nan):
            kept = C.apply_cuts(events, leaf, [C.Cut("/x", op, bound)], strict=strict,
                                missing=missing)
            want = {f"e{i}" for i, v in enumerate(VALUES)
                    if expected(v, op, bound, strict, missing)}
            assert {r.event_key for r in kept.collect()} == want, (op, bound)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("ab"), st.integers(0, 4)),
                min_size=1, max_size=12),
       st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["<", ">", "=="]),
                          st.integers(0, 4)), min_size=1, max_size=3))
def test_cuts_are_a_conjunction_of_independent_cuts(make_leaf, rows, cuts):
    leaf = make_leaf([(f"e{e}", f"/{d}", str(v)) for e, d, v in rows])
    want = set()
    for event in {f"e{e}" for e, _, _ in rows}:
        ok = True
        for name, op, bound in cuts:
            first = next((float(v) for e, d, v in rows if (f"e{e}", d) == (event, name)), "absent")
            ok = ok and expected(first, op, bound, False, "pass")
        if ok:
            want.add(event)
    wanted = [C.Cut(f"/{n}", op, float(b)) for n, op, b in cuts]
    kept = C.apply_cuts(leaf.select("event_key").distinct(), leaf, wanted)
    assert {r.event_key for r in kept.collect()} == want


def test_cut_names_can_be_patterns(make_leaf):
    leaf = make_leaf([("e1", "/a.b/x", "1"), ("e2", "/aXb/x", "9")])
    events = leaf.select("event_key").distinct()

    def kept(match, name):
        out = C.apply_cuts(events, leaf, [C.Cut(name, "<", 5.0)], match=match)
        return sorted(r.event_key for r in out.collect())

    assert kept("equals", "/a.b") == ["e1", "e2"]        # no such dataset: all pass
    assert kept("contains", "a.b") == ["e1", "e2"]       # only e1 is judged
    assert kept("regex", "a.b") == ["e1"]                # both are judged


# --- selection and groups ----------------------------------------------------------------

def test_first_value_may_be_null(make_leaf):
    leaf = make_leaf([("e", "/x", None), ("e", "/x", "5"), ("e", "/y", "7")])
    assert {(r.dataset_name, r.value) for r in S.first_values(leaf).collect()} \
        == {("/x", None), ("/y", "7")}
    row = S.pivot_columns(leaf, {"x": "/x", "z": "/z"}).head()
    assert (row.x, row.z) == (None, None)


def test_pivot_drops_events_without_any_chosen_dataset(make_leaf):
    leaf = make_leaf([("e1", "/x", "5"), ("e2", "/y", "7")])
    assert [r.event_key for r in S.pivot_columns(leaf, {"x": "/x"}).collect()] == ["e1"]


def test_group_holds_subgroups_but_not_siblings(make_leaf):
    leaf = make_leaf([("e1", "/g/a", "1"), ("e1", "/g/sub/b", "nan"), ("e1", "/gg/c", "3"),
                      ("e1", "/g/a", "9"), ("e2", "/g/other", "4")])
    row = G.group_metadata(leaf, "/g/a").collect()
    assert [(r.event_key, r.metadata) for r in row] == [("e1", {"/g/a": "1", "/g/sub/b": None})]
    same = G.group_metadata(leaf, "g/a", match="contains").collect()
    assert [(r.event_key, r.group_name, r.metadata) for r in same] \
        == [("e1", "/g", {"/g/a": "1", "/g/sub/b": None})]


def test_group_at_the_root(make_leaf):
    leaf = make_leaf([("e1", "/a", "1"), ("e1", "/g/b", "2")])
    for match in ("equals", "regex"):
        assert G.group_metadata(leaf, "/a", match=match).head().metadata == {"/a": "1", "/g/b": "2"}


def test_missing_payload_is_reported(spark, make_leaf):
    leaf = make_leaf([("e1", "/i", None), ("e2", "/i", None), ("e1", "/v", "1")])
    stored = spark.createDataFrame([("e1", "/i", [1.0, 2.0])],
                                   "event_key string, dataset_name string, data array<double>")
    stored = stored.withColumn("event_date", F.lit("2018-05-13").cast("date"))
    rows = {(r.event_key, r.dataset_name): r.data for r in P.attach_payload(leaf, stored).collect()}
    assert rows == {("e1", "/i"): [1.0, 2.0], ("e2", "/i"): None, ("e1", "/v"): None}
    assert [r.event_key for r in P.missing_payload(leaf, stored).collect()] == ["e2"]


# --- dictionaries ------------------------------------------------------------------------

@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.sampled_from("abc"),
                          st.sampled_from(["1", "2", None])), min_size=1, max_size=15))
def test_encode_then_decode_is_identity(make_leaf, rows):
    leaf = make_leaf([(f"e{e}", f"/{d}", v) for e, d, v in rows]).withColumns(
        {"shape": F.array(F.lit(1)), "dtype": F.lit("float64")})
    constants = D.number_constants(D.constant_values(leaf))
    by_name = {}
    for _, d, v in rows:
        by_name.setdefault(f"/{d}", set()).add(v or "")
    stored = {r.dataset_name: (r.ref, r.value) for r in constants.collect()}
    single = sorted(n for n, vs in by_name.items() if len(vs) == 1)
    assert stored == {n: (i, *by_name[n]) for i, n in enumerate(single, 2)}
    encoded = D.encode_constants(leaf, constants)
    assert all((r.ref is None) == (r.dataset_name not in stored) for r in encoded.collect())
    back = D.decode_constants(encoded, constants).select(leaf.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, leaf.collect()))


def test_changed_constant_keeps_its_value(spark, make_leaf):
    def shaped(rows):
        return make_leaf(rows).withColumns({"shape": F.array(F.lit(1)), "dtype": F.lit("x")})

    constants = D.number_constants(D.constant_values(shaped([("e1", "/a", "1")])))
    row = D.encode_constants(shaped([("e2", "/a", "2")]), constants).head()
    assert (row.ref, row.value) == (None, "2")


def test_constant_options(make_leaf):
    leaf = make_leaf([("e1", "/a", "1"), ("e2", "/a", "1"), ("e1", "/b", "1"), ("e1", "/c", None)]
                     ).withColumns({"shape": F.array(F.lit(1)), "dtype": F.lit("x")})

    def names(**kw):
        return {r.dataset_name for r in D.constant_values(leaf, **kw).collect()}

    assert names() == {"/a", "/b", "/c"}
    assert names(min_rows=2) == {"/a"} and names(scalars_only=True) == {"/a", "/b"}


def test_searches(spark):
    names = spark.createDataFrame([("/T/XMPP-STREAK/width",), ("/T/XMPP/width",), ("/zz",)],
                                  "dataset_name string")
    comments = spark.createDataFrame([("Position in MM", "/T/pos"), ("", "/T/none")],
                                     "comment string, dataset_name string")

    def found(keywords, phrase):
        return {r[0] for r in D.matched_names(names, comments, keywords, phrase).collect()}

    assert found("streak xmpp ", "") == {"/T/XMPP-STREAK/width"}
    assert found("XMPP", "") == {"/T/XMPP-STREAK/width", "/T/XMPP/width"}
    assert found("", "mm") == {"/T/pos"} and found("", "MM") == {"/T/pos"}
    assert found("", "") == set() and found("/z", "in mm") == {"/zz", "/T/pos"}


def test_merge_prefers_new_comments(spark):
    def frame(*rows):
        return spark.createDataFrame(rows, "comment string, dataset_name string")

    merged = D.merge_comments(frame(("a", "/z"), ("b", "/b")), frame(("a", "/a"), ("c", "/c")))
    assert {tuple(r) for r in merged.collect()} == {("a", "/a"), ("b", "/b"), ("c", "/c")}


# --- flattening --------------------------------------------------------------------------

def test_flatten_any_depth(spark):
    df = spark.sql("""SELECT 'k' AS key, named_struct(
        'attrs', map('unit', 'mm'), 'x', 1.5D, 'gone', CAST(NULL AS INT),
        'list', array(named_struct('inner', array(named_struct('v', 1), named_struct('v', 2)))),
        'm', map('p', named_struct('q', array(1, 2, 3))), 'img', array(array(1, 2), array(3, 4)),
        'one', array(7L), 'none', CAST(array() AS array<int>)) AS top, true AS flag""")
    rows = FL.flatten_leaves(df, ["key"]).orderBy("seq").collect()
    got = [(r.dataset_name, r.group_name, r.value, r.shape, r.size, r.dtype) for r in rows]
    assert got == [
        ("/top/x", "/top", "1.5", [], 1, "float64"),
        ("/top/list/0/inner/0/v", "/top/list/0/inner/0", "1", [], 1, "int32"),
        ("/top/list/0/inner/1/v", "/top/list/0/inner/1", "2", [], 1, "int32"),
        ("/top/m/p/q", "/top/m/p", None, [3], 3, "int32"),
        ("/top/img", "/top", None, [2, 2], 4, "int32"),
        ("/top/one", "/top", "7", [1], 1, "int64"),
        ("/top/none", "/top", None, [0], 0, "int32"),
        ("/flag", "/", "true", [], 1, "bool")]
    assert [r.attrs for r in rows][:2] == [{"unit": "mm"}, {}]
    assert [r.value_num for r in rows][:2] == [1.5, 1.0]
