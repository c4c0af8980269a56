"""Quantities and facts in free text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Number followed by a unit, and a quoted word.
QUANTITY = r"^([0-9.+\-eE]+?)\s*([a-z]+)$"
QUOTED = '"([^"]*)"'


def to_picoseconds(text: Column) -> Column:
    """`12.5 ns` or `200 ps` in picoseconds; other units are NULL."""
    number = F.regexp_extract(F.trim(text), QUANTITY, 1).try_cast("double")
    unit = F.regexp_extract(F.trim(text), QUANTITY, 2)
    return F.when(unit == "ns", number * 1000).when(unit == "ps", number)


def text_facts(info: Column) -> dict[str, Column]:
    """Slit width, shutter and mode of a comma-separated description; the last part that
    states a fact decides it, NULL when none does."""
    parts = F.split(info, ",")

    def has(p: Column, *words: str) -> Column:
        out = F.contains(p, F.lit(words[0]))
        for w in words[1:]:
            out = out & F.contains(p, F.lit(w))
        return out

    def focus(p: Column) -> Column:
        return has(p, "focus") & ~has(p, "time") & ~has(p, "scaling")

    def last(condition) -> Column:
        return F.try_element_at(F.filter(parts, condition), F.lit(-1))

    shutter = last(lambda p: has(p, "shutter"))
    mode = last(lambda p: has(p, "operate") | focus(p))
    return {
        "slit_width": F.regexp_extract(last(lambda p: has(p, "slit", "width")), QUOTED, 1)
                       .try_cast("double"),
        "shutter_open": F.regexp_extract(shutter, QUOTED, 1) == "open",
        "operate": ~focus(mode),
    }
