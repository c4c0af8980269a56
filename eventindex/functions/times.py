"""Zone, day and epoch arithmetic. Stored times are UTC; days are local calendar days."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

ZONE = "Europe/Zurich"
PY_FORMAT = "%Y-%m-%d %H:%M:%S"
SQL_FORMAT = "yyyy-MM-dd HH:mm:ss"
NS_PER_S = 1_000_000_000


def ns_to_ts(ns: Column) -> Column:
    """Nanoseconds since the epoch, floored to the second (integer division, no float)."""
    return F.timestamp_seconds(F.call_function("div", ns, F.lit(NS_PER_S)))


def local_wall(ts: Column) -> Column:
    return F.from_utc_timestamp(ts, ZONE)


def local_day(ts: Column) -> Column:
    return F.to_date(local_wall(ts))


def day_dir(day: Column) -> Column:
    """`yyyy/MM/dd`, both parts zero-padded."""
    return F.date_format(day, "yyyy/MM/dd")


def local_text_to_ts(text: Column) -> Column:
    """Local wall-clock text to an instant; malformed text is NULL."""
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(SQL_FORMAT)), ZONE)


def days_between(start: Column, end: Column) -> Column:
    """Array of all days from start to end, both included; empty when end is before start."""
    first, last = F.to_date(start), F.to_date(end)
    days = F.sequence(first, F.greatest(first, last), F.expr("INTERVAL 1 DAY"))
    return F.when(first <= last, days).otherwise(F.array().cast("array<date>"))


def whole_hours(start: str, end: str) -> tuple[int, int] | None:
    """Seconds [lo, hi) of whole hours that surely lie inside a range, an hour left off at each end
    for the hour that the clocks repeat; None for an open range."""
    if not start and not end:
        return None

    def seconds(text: str) -> int:
        wall = datetime.strptime(text, PY_FORMAT).replace(tzinfo=ZoneInfo(ZONE))
        return int(wall.timestamp()) // 3_600 * 3_600

    lo = seconds(start) + 7_200 if start else -(1 << 40)
    hi = seconds(end) - 3_600 if end else 1 << 40
    return lo, max(lo, hi)


def range_condition(start: str, end: str, ts: str = "event_ts", day: str = "event_date") -> Column:
    """Both ends included, an empty text is an open end. The day bounds prune partitions, the
    instants decide."""
    day, ts = F.col(day), F.col(ts)

    def instant(t: datetime) -> Column:
        # seconds, so the zone of the session has no say
        return F.timestamp_seconds(F.lit(int(t.replace(tzinfo=ZoneInfo(ZONE)).timestamp())))

    out = F.lit(True)
    if start:
        lo = datetime.strptime(start, PY_FORMAT)
        out = out & (day >= F.lit(lo.date())) & (ts >= instant(lo))
    if end:
        hi = datetime.strptime(end, PY_FORMAT)
        out = out & (day <= F.lit(hi.date())) & (ts <= instant(hi))
    return out
