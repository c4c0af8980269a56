"""Values, attributes and shapes of leaf rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ATTRS = "map<string,string>"


def decode_utf8(raw: Column) -> Column:
    """Bytes as text; bytes that are no UTF-8 as hexadecimal digits."""
    return F.coalesce(F.try_validate_utf8(raw.cast("string")), F.hex(raw))


def attrs_to_text(attrs: Column) -> Column:
    return F.when(F.size(attrs) > 0, F.to_json(attrs)).otherwise(F.lit(""))


def text_to_attrs(text: Column) -> Column:
    """JSON or single-quoted dictionary text to a map; anything else is the empty map."""
    return F.coalesce(F.from_json(text, ATTRS), F.create_map().cast(ATTRS))


def value_by_dtype(size: Column, dtype: Column, raw: Column) -> Column:
    """Text of a one-element dataset: code point for one-byte text, else the trimmed text."""
    return (F.when(size != 1, F.lit(None).cast("string"))
            .when(dtype == "|S1", F.ascii(raw).cast("string"))
            .otherwise(F.trim(raw)))


def to_number(value: Column) -> Column:
    return value.try_cast("double")


def missing_to_null(value: Column) -> Column:
    """The stored text `nan` stands for a missing value."""
    return F.nullif(value, F.lit("nan"))


def _last_with_key(attrs: Column, part: str) -> Column:
    kept = F.map_filter(attrs, lambda k, v: F.contains(k, F.lit(part)))
    return F.try_element_at(F.map_values(kept), F.lit(-1))


def attr_triple(group_attrs: Column, dataset_attrs: Column) -> dict[str, Column]:
    """Comment, acquisition stamp and exception: the group's, or the dataset's when the group
    holds nothing but defaults."""
    parts = [("comment", "comment", ""), ("acq_stamp", "acqStamp", "nan"),
             ("exception", "exception", "False")]

    def triple(attrs: Column) -> dict[str, Column]:
        return {out: F.coalesce(_last_with_key(attrs, part), F.lit(default))
                for out, part, default in parts}

    group, own = triple(group_attrs), triple(dataset_attrs)
    plain = F.lit(True)
    for out, _, default in parts:
        plain = plain & (group[out] == default)
    return {out: F.when(plain, own[out]).otherwise(group[out]) for out in group}


def parse_shape(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)),
                       lambda x: x.cast("int"))


def shape_text(shape: Column) -> Column:
    """`(512, 672)`; one dimension is written `(5,)`, a scalar `()`."""
    tail = F.when(F.size(shape) == 1, F.lit(",)")).otherwise(F.lit(")"))
    return F.concat(F.lit("("), F.array_join(shape.cast("array<string>"), ", "), tail)


def shape_size(shape: Column) -> Column:
    return F.aggregate(shape, F.lit(1).cast("bigint"), lambda acc, x: acc * x.cast("bigint"))


def dimension(metadata: Column, part: str) -> Column:
    """Width or height: last entry whose key contains the word in any case; NULL if absent
    or zero."""
    kept = F.map_filter(metadata, lambda k, v: F.contains(F.lower(k), F.lit(part)) & v.isNotNull())
    size = F.try_element_at(F.map_values(kept), F.lit(-1)).try_cast("double").try_cast("int")
    return F.when(size > 0, size)
