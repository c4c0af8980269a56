"""Shortlists by recorded settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventindex.functions.text import text_facts


def with_facts(df: DataFrame, info: str = "info") -> DataFrame:
    return df.withColumns(text_facts(F.col(info)))


def keep_operating(df: DataFrame, info: str = "info") -> DataFrame:
    """Shutter open and operate mode; the free text gives way to the slit width."""
    return (df.where("shutter_open AND operate")
            .drop(info, "shutter_open", "operate"))


def shortlist(df: DataFrame, **wanted) -> DataFrame:
    """Rows equal to all the given values; a number compares as a number."""
    out = df
    for column, value in wanted.items():
        out = out.where(F.col(column) == F.lit(value))
    return out
