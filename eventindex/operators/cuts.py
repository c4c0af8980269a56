"""Numeric cuts on events. A cut looks at the first value of one dataset in an event."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from eventindex.operators.select import first_of, fresh_keys, name_condition

CUT = r"^\s*(\S+)\s+(\S+)\s+(\S+)\s*$"
OPERATORS = ("<", ">", "==")


@dataclass(frozen=True)
class Cut:
    name: str
    op: str
    bound: float


def parse_cuts(text: str) -> list[Cut]:
    """`"<name> <op> <number>, ..."`; malformed text is an error, never a silent no-op."""
    cuts = []
    for part in text.split(",") if text.strip() else []:
        fields = part.split()
        if len(fields) != 3 or fields[1] not in OPERATORS:
            raise ValueError(f"malformed cut: {part!r}")
        cuts.append(Cut(fields[0], fields[1], float(fields[2])))
    return cuts


def cut_rows(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Cut text held in a column, one row per cut; a malformed one has NULL in `op`."""
    part = F.col("_cut")
    name, op, number = (F.regexp_extract(part, CUT, i) for i in (1, 2, 3))
    bound = number.try_cast("double")
    good = op.isin(*OPERATORS) & bound.isNotNull()
    return (df.select(*keep, F.posexplode(F.split(text, ",")).alias("cut_id", "_cut"))
            .where(F.trim(part) != "")
            .select(*keep, "cut_id", name.alias("dataset_name"), F.when(good, op).alias("op"),
                    F.when(good, bound).alias("bound")))


def comparable() -> Column:
    """Number a cut compares: NaN where the dataset holds no single value, NULL where it holds
    text that is no number. The size tells them apart without reading the stored text."""
    no_value = F.col("value_num").isNull() & ~F.equal_null(F.col("size"), F.lit(1))
    return F.when(no_value, F.lit(math.nan)).otherwise(F.col("value_num"))


def passes(value: Column, cut: Cut, strict: bool = False, missing: str = "pass") -> Column:
    """Does the first value pass? Bounds are inclusive unless strict. NaN passes `<` and `>`
    and fails `==`. NULL (dataset absent, or not a number) passes unless missing="fail"."""
    bound = F.lit(cut.bound)
    number = ~F.isnan(value)
    if math.isnan(cut.bound):  # nothing is above, below or equal to it
        ok = F.when(value.isNotNull(), F.lit(cut.op != "=="))
    elif cut.op == "==":
        ok = number & (value == bound)
    elif cut.op == "<":
        ok = ~number | ((value < bound) if strict else (value <= bound))
    elif cut.op == ">":
        ok = ~number | ((value > bound) if strict else (value >= bound))
    else:
        raise ValueError(f"unknown operator {cut.op!r}")
    return F.coalesce(ok, F.lit(missing != "fail"))


def cut_aggregates(cuts: list[Cut], match: str = "equals") -> dict[str, Column]:
    """First value per cut dataset, as aggregates over the leaf rows of one event. Number and
    order are fixed-width, so the aggregation stays hash based."""
    return {f"_cut{i}": first_of(comparable(), name_condition(c.name, match))
            for i, c in enumerate(cuts)}


def all_pass(cuts: list[Cut], strict: bool = False, missing: str = "pass") -> Column:
    """Conjunction over the columns made by cut_aggregates."""
    out = F.lit(True)
    for i, c in enumerate(cuts):
        out = out & passes(F.col(f"_cut{i}"), c, strict, missing)
    return out


def any_cut_name(cuts: list[Cut], match: str = "equals") -> Column:
    return name_condition([c.name for c in cuts], match)


def judge_events(leaf: DataFrame, cuts: list[Cut], match: str = "equals", strict: bool = False,
                 missing: str = "pass") -> DataFrame:
    """(event_key, passed) of every event that holds one of the cut datasets."""
    firsts = [agg.alias(name) for name, agg in cut_aggregates(cuts, match).items()]
    return (leaf.where(any_cut_name(cuts, match))
            .groupBy("event_key").agg(*firsts)
            .select("event_key", all_pass(cuts, strict, missing).alias("passed")))


def apply_cuts(rows: DataFrame, leaf: DataFrame, cuts: list[Cut], match: str = "equals",
               strict: bool = False, missing: str = "pass") -> DataFrame:
    """Rows of events that pass. An event with none of the cut datasets has no judgement, so
    by default failing events are removed; with missing="fail" passing events are kept."""
    if not cuts:
        return rows
    judged = fresh_keys(judge_events(leaf, cuts, match, strict, missing))
    if missing == "fail":
        return rows.join(judged.where("passed").select("event_key"), "event_key", "left_semi")
    return rows.join(judged.where("NOT passed").select("event_key"), "event_key", "left_anti")
