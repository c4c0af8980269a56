"""Event file names and dataset paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from eventindex.functions.times import local_day, ns_to_ts

# The name and path formats of the indexed tree.
EVENT_NAME = r"^(?:optimized_)?(\d{19})_(\d+)_(\d+)$"
DAY_PATH = r"/(\d{4})/(\d{1,2})/(\d{1,2})/(?:[^/]+\.zip!/)?([^/]+?)(?:\.[^/]*)?$"  # in an archive or not
STEM = r"([^/]+?)(?:\.[^/]*)?$"


def stem(path: Column) -> Column:
    """Last path part up to its first dot."""
    # sought in that part only, for the pattern is tried from every character
    return F.regexp_extract(F.substring_index(path, "/", -1), STEM, 1)


def with_extension(path: Column, extension: str) -> Column:
    return F.concat(stem(path), F.lit("." + extension))


def event_fields(path: Column) -> dict[str, Column]:
    """Fields of an event file name; all NULL when the name is malformed."""
    name = stem(path)

    def number(group: int) -> Column:
        return F.regexp_extract(name, EVENT_NAME, group).try_cast("bigint")

    ns, n1, n2 = number(1), number(2), number(3)
    ts = ns_to_ts(ns)
    return {
        "event_key": F.nullif(F.regexp_replace(
            F.regexp_extract(name, EVENT_NAME, 0), "^optimized_", ""), F.lit("")),
        "event_ns": ns,
        "event_ts": ts,
        "n1": n1,
        "n2": n2,
        "event_date": local_day(ts),
    }


def path_fields(path: Column) -> dict[str, Column]:
    """Year, month, day and stem of `.../YYYY/MM/DD/<stem>.<ext>`; NULL where absent."""
    def part(group: int) -> Column:
        return F.regexp_extract(path, DAY_PATH, group)

    year, month, day = (part(i).try_cast("int") for i in (1, 2, 3))
    return {
        "year": year,
        "month": month,
        "day": day,
        "stem": F.nullif(part(4), F.lit("")),
        # through text, so an impossible day is NULL and not an error
        "path_date": F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"),
                                 F.lpad(day.cast("string"), 2, "0")).try_cast("date"),
    }


def leaf_name(dataset_name: Column) -> Column:
    return F.element_at(F.split(dataset_name, "/"), -1)


def parent_group(dataset_name: str) -> str:
    """Group path of an absolute dataset path."""
    return dataset_name.rsplit("/", 1)[0] or "/"


def export_name(dataset_name: Column, event_ts: Column, extension: str = "png") -> Column:
    """`<leaf>_<epoch seconds>.<extension>`."""
    return F.concat(F.concat_ws("_", leaf_name(dataset_name), F.unix_timestamp(event_ts)),
                    F.lit("." + extension))
