"""Positions of events through the rank directory."""

import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from eventindex.functions.times import whole_hours
from eventindex.operators import ordinals as O, ranks as R, select as S
from eventindex.session import new_path
from tests.test_registry import plan

UTC = timezone.utc


def listing_of(spark, n=600, seed=1):
    """Events over some days, many at one instant, with the hour that the clocks repeat."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        at = datetime(2018, 10, 27, 20, tzinfo=UTC) + timedelta(seconds=rng.choice([0, 1, 3599, 3600, rng.randrange(200_000)]))
        rows.append((f"k{rng.randrange(10 ** 6)}-{k}", at))
    return spark.createDataFrame(rows, "event_key string, event_ts timestamp").withColumn(
        "event_date", F.to_date(F.from_utc_timestamp("event_ts", "Europe/Zurich")))


def sorted_keys(rows):
    return [r["event_key"] for r in sorted(rows, key=lambda r: (r["event_ts"], r["event_key"]))]


@pytest.mark.parametrize("spec", ["0", "0-50", "7,3,599,600", "100-250,400-9000000000", "0-9000000000", "700"])
@pytest.mark.parametrize("long_hour", [10 ** 6, 20])
def test_positions_equal_a_sorted_list(spark, monkeypatch, spec, long_hour):
    monkeypatch.setattr(R, "LONG_HOUR", long_hour)
    df = listing_of(spark)
    listed = sorted_keys(df.collect())
    got = {r["ordinal"]: r["event_key"] for r in O.select_ordinals(df, spec).collect()}
    want = {i: listed[i] for lo, hi in O.parse_ordinals(spec) for i in range(lo, min(hi, len(listed) - 1) + 1)}
    assert got == want


@pytest.mark.parametrize("start,end", [("", ""), ("2018-10-28 02:30:00", "2018-10-29 01:15:10"),
                                       ("2018-10-28 00:00:00", ""), ("", "2018-10-28 02:59:59"),
                                       ("2018-10-28 03:00:00", "2018-10-28 03:00:01"),
                                       ("2018-10-29 00:00:00", "2018-10-28 00:00:00")])
def test_stored_counts_serve_any_range(spark, start, end):
    df = listing_of(spark, 900, 2)
    stored = R.rank_directory(df, "event_date")
    rows = S.time_range(df, start, end)
    listed = sorted_keys(rows.collect())
    got = O.select_ordinals(rows, "0-3,200-260", directory=stored, inner=whole_hours(start, end)).collect()
    want = {i: listed[i] for i in [*range(4), *range(200, 261)] if i < len(listed)}
    assert {r["ordinal"]: r["event_key"] for r in got} == want


def test_only_the_days_of_the_positions_are_read(spark):
    path = new_path(spark, "listing")
    listing_of(spark).write.partitionBy("event_date").parquet(path)
    df = spark.read.parquet(path)
    directory = R.rank_directory(df, "event_date").collect()
    stored = spark.createDataFrame(directory, "event_date date, start bigint, n bigint")
    chosen = O.select_ordinals(df, "0-50", directory=stored)
    text = plan(chosen)
    days = re.search(r"PartitionFilters: .*", text)[0]
    assert "event_date" in days and "2018-10-27" in days and "2018-10-29" not in days
    assert "event_ts" in re.search(r"PushedFilters: .*", text)[0]
    # no task gets the whole listing
    assert "SinglePartition" not in text and len(chosen.collect()) == 51


def test_an_empty_listing(spark):
    assert O.select_ordinals(listing_of(spark).limit(0), "0-5").count() == 0
