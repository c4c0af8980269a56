from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventindex.functions import arrays as A, names as N, numeric, text as X, times as T, values as V


def one(spark, *columns, **kw):
    df = spark.range(1)
    for name, value in kw.items():
        df = df.withColumn(name, value)
    return df.select(*columns).head()


def test_event_name(spark):
    f = N.event_fields(F.lit("/x/2018/05/13/1526218206135000000_117_613.csv"))
    row = one(spark, *[c.alias(k) for k, c in f.items()],
              F.unix_timestamp(f["event_ts"]).alias("s"))
    assert (row.s, row.n1, row.n2) == (1526218206, 117, 613)
    assert row.event_key == "1526218206135000000_117_613"
    assert row.event_ns == 1526218206135000000
    assert row.event_date == date(2018, 5, 13)


def test_optimized_prefix_and_malformed_names(spark):
    good = N.event_fields(F.lit("optimized_1526218206135000000_117_613.h5"))["event_key"]
    short = N.event_fields(F.lit("152621820613500000_117_613.h5"))
    row = one(spark, good.alias("good"), *[c.alias(k) for k, c in short.items()])
    assert row.good == "1526218206135000000_117_613"
    assert [row[k] for k in short] == [None] * len(short)


def test_local_day_differs_from_utc_day(spark):
    # 22:30 UTC in May is half past midnight of the next day in the local zone
    ns = 1526164200 * 10**9
    assert one(spark, N.event_fields(F.lit(f"{ns}_1_2"))["event_date"].alias("d")).d \
        == date(2018, 5, 13)


def test_stem_extension_and_names(spark):
    path = F.lit("/a/b/1526218206135000000_117_613.csv")
    row = one(spark, N.stem(path).alias("stem"), N.with_extension(path, "h5").alias("h5"),
              N.leaf_name(F.lit("/a/b/c")).alias("leaf"),
              N.export_name(F.lit("/a/b/img"), F.timestamp_seconds(F.lit(1526218206))).alias("png"))
    assert row.stem == "1526218206135000000_117_613"
    assert row.h5 == "1526218206135000000_117_613.h5"
    assert (row.leaf, row.png) == ("c", "img_1526218206.png")
    assert (N.parent_group("/a/b/c"), N.parent_group("/c")) == ("/a/b", "/")


def test_path_fields(spark):
    def fields(path):
        return one(spark, *[c.alias(k) for k, c in N.path_fields(F.lit(path)).items()])

    assert fields("/r/2018/5/03/x_1.h5")[:] == (2018, 5, 3, "x_1", date(2018, 5, 3))
    assert fields("/r/2018/02/31/x.h5").path_date is None
    assert fields("/r/x.h5").year is None


def test_time_text(spark):
    seconds = F.unix_timestamp(T.local_text_to_ts(F.col("t")))
    row = one(spark, seconds.alias("s"), t=F.lit("2019-07-12 12:12:00"))
    assert row.s == 1562926320
    assert one(spark, seconds.alias("s"), t=F.lit("2019-07-12")).s is None


def test_days_of_may(spark):
    days = one(spark, T.days_between(F.lit("2018-05-01"), F.lit("2018-05-31")).alias("d"),
               T.days_between(F.lit("2018-05-02"), F.lit("2018-05-01")).alias("none"))
    assert len(days.d) == 31 and days.none == []


def test_range_text_must_be_complete(spark):
    with pytest.raises(ValueError):
        T.range_condition("2018-05-01", "2018-05-02")


def test_attributes(spark):
    row = one(spark, V.text_to_attrs(F.lit("{'key1': 'value1', 'key2': 'value2'}")).alias("python"),
              V.text_to_attrs(F.lit('{"key1": "value1"}')).alias("json"),
              V.text_to_attrs(F.lit("__import__('os')")).alias("broken"),
              V.attrs_to_text(F.create_map().cast(V.ATTRS)).alias("empty"),
              V.attrs_to_text(F.create_map(F.lit("k"), F.lit("v"))).alias("text"))
    assert row.python == {"key1": "value1", "key2": "value2"}
    assert row.json == {"key1": "value1"} and row.broken == {}
    assert (row.empty, row.text) == ("", '{"k":"v"}')


def test_decode(spark):
    row = one(spark, V.decode_utf8(F.lit(b"/0x8")).alias("good"),
              V.decode_utf8(F.lit(b"\xff\x01")).alias("bad"))
    assert (row.good, row.bad) == ("/0x8", "FF01")


def test_value_by_dtype(spark):
    def value(size, dtype, raw):
        return one(spark, V.value_by_dtype(F.lit(size), F.lit(dtype), F.lit(raw)).alias("v")).v

    assert value(1, "|S1", "A") == "65"
    assert value(1, "|S8", " ab ") == "ab"
    assert value(1, "int32", "672") == "672"
    assert value(0, "float64", "1") is None and value(2, "float64", "1") is None


def test_attr_triple(spark):
    def triple(group, own):
        def m(d):
            return F.create_map(*[F.lit(x) for kv in d.items() for x in kv]).cast(V.ATTRS)
        return one(spark, *[c.alias(k) for k, c in V.attr_triple(m(group), m(own)).items()])[:]

    assert triple({}, {}) == ("", "nan", "False")
    assert triple({"a_comment": "x", "comment": "y"}, {"acqStamp": "1"}) == ("y", "nan", "False")
    assert triple({"other": "x"}, {"acqStamp": "1"}) == ("", "1", "False")


def test_shapes(spark):
    row = one(spark, V.parse_shape(F.lit("(512, 672)")).alias("two"),
              V.parse_shape(F.lit("(5,)")).alias("line"), V.parse_shape(F.lit("()")).alias("none"),
              V.shape_text(F.array(F.lit(512), F.lit(672))).alias("text"),
              V.shape_size(F.array(F.lit(512), F.lit(672))).alias("size"),
              V.shape_text(F.array(F.lit(5))).alias("tuple"))
    assert row[:] == ([512, 672], [5], [], "(512, 672)", 344064, "(5,)")


def test_dimensions(spark):
    m = F.create_map(*[F.lit(x) for x in ("a/Width", "8", "b/imageWIDTH", "672", "h", "1")])
    row = one(spark, V.dimension(m, "width").alias("w"), V.dimension(m, "height").alias("h"))
    assert row[:] == (672, None)


def test_units(spark):
    def ps(t):
        return one(spark, X.to_picoseconds(F.lit(t)).alias("p")).p

    assert [ps(t) for t in ("200 ps", "1 ns", "2.5ns", "3 us", "x", "1e3 ps")] \
        == [200.0, 1000.0, 2500.0, None, None, 1000.0]


def test_facts(spark):
    def facts(t):
        return one(spark, *[c.alias(k) for k, c in X.text_facts(F.lit(t)).items()])[:]

    assert facts('slit width="20",shutter="open",operate') == (20.0, True, True)
    assert facts('shutter="closed",focus') == (None, False, False)
    assert facts('focus time="3",slit="1"') == (None, None, None)
    assert facts('operate,focus') == (None, None, False)


def test_axes(spark):
    row = one(spark, A.linear_axis(F.lit(5), -7.5, 7.5).alias("x"),
              A.pixel_axis(F.lit(672), 43.2).alias("mm"),
              A.repair_axis(F.array(*[F.lit(float(v)) for v in (0, 2, 4, 6, 99)]), F.lit(5))
              .alias("fixed"),
              A.repair_axis(F.array(*[F.lit(float(v)) for v in (0, 2, 4, 6, 99)]), F.lit(3))
              .alias("cropped"),
              A.linear_axis(F.lit(1), 3.0, 4.0).alias("single"))
    assert row.x == [-7.5, -3.75, 0.0, 3.75, 7.5] and row.single == [3.0]
    want = (672 / 43.2) * np.linspace(0, 1, 672)
    assert np.allclose(row.mm, want - want.mean())
    assert row.fixed == [0, 2, 4, 6, 8] and row.cropped == [0, 2, 4]


def test_array_statistics(spark):
    xs = F.array(*[F.lit(v) for v in (1.0, 4.0, 2.0, 4.0)])
    row = one(spark, A.array_sum(xs).alias("s"), A.zero_mean(xs).alias("z"),
              A.sample_variance(xs).alias("v"), A.peak_bin(xs).alias("p"),
              A.parse_numbers(F.lit(" 1.5  2e3\tx ")).alias("n"),
              A.frequency_step(F.array(F.lit(0.0), F.lit(500.0))).alias("f"))
    assert row.s == 11.0 and row.z == [-1.75, 1.25, -0.75, 1.25] and row.p == 1
    assert np.isclose(row.v, np.cov([1.0, 4.0, 2.0, 4.0])) and row.n == [1.5, 2000.0, None]
    assert row.f == 2.0


def brute_median(frame):
    p = np.pad(frame, 1)
    return np.array([[np.median(p[r:r + 3, c:c + 3]) for c in range(frame.shape[1])]
                     for r in range(frame.shape[0])])


@pytest.mark.parametrize("shape", [(1, 1), (1, 5), (4, 1), (7, 9), (8, 8)])
def test_median_against_brute_force(shape):
    frame = np.random.default_rng(1).normal(size=shape)
    assert np.array_equal(numeric._medians(frame), brute_median(frame))


def test_frames_of_real_size(spark):
    """512 x 672 pixels, and one frame whose array does not fit its dimensions."""
    rng = np.random.default_rng(2)
    frames = rng.normal(size=(2, 512, 672)).round(3)
    rows = [(i, f.ravel().tolist(), 672, 512) for i, f in enumerate(frames)]
    df = spark.createDataFrame([*rows, (9, [1.0], 672, 512)],
                               "id int, data array<double>, w int, h int")
    out = df.select("id", numeric.median3x3("data", "w", "h").alias("m"),
                    numeric.projection_spectrum("data", "w", "h", F.lit(254)).alias("s"),
                    numeric.column_peaks("data", "w", "h").alias("c"),
                    A.row_means(F.col("data"), F.col("w"), F.col("h")).alias("p")).collect()
    got = {r.id: r for r in out}
    assert got[9][1:] == (None, None, None, None)
    for i, frame in enumerate(frames):
        inner = np.array(got[i].m).reshape(512, 672)[100:104, 100:104]
        assert np.array_equal(inner, brute_median(frame[99:105, 99:105])[1:5, 1:5])
        p = frame.mean(axis=1)
        assert np.allclose(got[i].p, p)
        assert np.allclose(got[i].s, np.abs(np.fft.fft(p - p.mean()))[:254], atol=1e-9)
        full = np.abs(np.fft.fft(frame, axis=0)).max(axis=0)
        assert np.allclose(got[i].c, full)


def test_range_does_not_depend_on_the_zone_of_the_session(spark):
    rows = spark.sql("SELECT id, timestamp_seconds(1526119200 + 1800 * id) AS event_ts, DATE'2018-05-12' AS event_date "
                     "FROM range(-3, 4)")     # 1526119200: 12:00 in Zurich
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            inside = rows.where(T.range_condition("2018-05-12 11:30:00", "2018-05-12 13:00:00"))
            assert sorted(r["id"] for r in inside.collect()) == [-1, 0, 1, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
