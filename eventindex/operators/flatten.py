"""Nested rows to leaf rows, in one pass and one generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Type names of stored datasets.
DTYPES = {"double": "float64", "float": "float32", "bigint": "int64", "int": "int32",
          "smallint": "int16", "tinyint": "int8", "boolean": "bool", "string": "object",
          "binary": "S"}

_NO_ENTRIES = ("array<struct<dataset_name:string,group_name:string,attrs:map<string,string>,"
               "value:string,shape:array<int>,size:bigint,dtype:string>>")


def _is_group(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.MapType)) or (
        isinstance(dtype, T.ArrayType) and _is_group(dtype.elementType))


def _dataset(name: Column, group: Column, attrs: Column, col: Column, dtype: T.DataType) -> Column:
    shape, size, value, base = F.array().cast("array<int>"), F.lit(1).cast("bigint"), col, dtype
    if isinstance(dtype, T.ArrayType):
        base = dtype.elementType
        size, value = F.size(col).cast("bigint"), F.try_element_at(col, F.lit(1))
        shape = F.array(F.size(col))
        if isinstance(base, T.ArrayType):  # two dimensions, shaped after the first row
            base, columns = base.elementType, F.size(value)
            shape, value = F.array(F.size(col), columns), F.try_element_at(value, F.lit(1))
            size = F.aggregate(col, F.lit(0).cast("bigint"),
                               lambda acc, row: acc + F.size(row).cast("bigint"))
    text = F.when(size == 1, value.cast("string"))
    kind = F.lit(DTYPES.get(base.simpleString(), base.simpleString()))
    entry = F.struct(name.alias("dataset_name"), group.alias("group_name"), attrs.alias("attrs"),
                     text.alias("value"), shape.alias("shape"), size.alias("size"),
                     kind.alias("dtype"))
    # a NULL column is a dataset the container does not hold
    return F.when(col.isNotNull(), entry)


def _child(path: Column, name: Column) -> Column:
    return F.concat(F.when(path == "/", F.lit("")).otherwise(path), F.lit("/"), name)


def _none() -> Column:
    return F.array().cast(_NO_ENTRIES)


def _members(path: Column, attrs: Column, members, attrs_field: str) -> Column:
    """Entries of (name, column, type) members in order; neighbouring datasets share one array."""
    parts, run = [], []

    def close():
        if run:
            parts.append(F.array_compact(F.array(*run)))
            run.clear()

    for name, col, dtype in members:
        if _is_group(dtype):
            close()
            no_attrs = F.create_map().cast("map<string,string>")
            parts.append(_walk(_child(path, name), no_attrs, col, dtype, attrs_field))
        else:
            run.append(_dataset(_child(path, name), path, attrs, col, dtype))
    close()
    return F.concat(*parts) if len(parts) > 1 else parts[0] if parts else _none()


def _walk(path: Column, attrs: Column, col: Column, dtype: T.DataType, attrs_field: str) -> Column:
    """Array of leaf entries below one group."""
    if isinstance(dtype, T.ArrayType):
        out = F.flatten(F.transform(col, lambda x, i: _walk(
            _child(path, i.cast("string")), attrs, x, dtype.elementType, attrs_field)))
    elif isinstance(dtype, T.MapType):
        out = F.flatten(F.transform(F.map_entries(col), lambda e: _members(
            path, attrs, [(e["key"].cast("string"), e["value"], dtype.valueType)], attrs_field)))
    else:
        own = attrs
        if any(f.name == attrs_field and isinstance(f.dataType, T.MapType) for f in dtype.fields):
            own = F.coalesce(col[attrs_field], F.create_map().cast("map<string,string>"))
        out = _members(path, own, [(F.lit(f.name), col[f.name], f.dataType)
                                   for f in dtype.fields if f.name != attrs_field], attrs_field)
    return F.when(col.isNull(), _none()).otherwise(out)


def flatten_leaves(df: DataFrame, keys: list[str], root: str = "/",
                   attrs_field: str = "attrs") -> DataFrame:
    """Leaf rows of nested columns. Structs and maps are groups, arrays of groups are groups
    numbered from 0, everything else is a dataset. The walk over the schema runs on the driver;
    the data is generated by a single `inline`, at any depth, without re-reading it. `seq` is
    the walk order."""
    nested = [f for f in df.schema.fields if f.name not in keys]
    top, no_attrs = F.lit(root), F.create_map().cast("map<string,string>")
    entries = _members(top, no_attrs, [(F.lit(f.name), F.col(f.name), f.dataType)
                                       for f in nested], attrs_field)
    return (df.select(*keys, F.posexplode(entries).alias("_pos", "_leaf"))
            .select(*keys, "_leaf.*", F.col("_pos").cast("bigint").alias("seq"))
            .withColumn("value_num", F.col("value").try_cast("double")))
