"""Canonical JSON of any type: names and map keys in order at every level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def canonical(x: Column, kind: DataType) -> Column:
    """x with the fields of its structs in order of name and the entries of its maps in order of key, however deep.

    Values of a map are looked up by key, so that they may be of any type; a key that repeats has been one since the map was made.
    """
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        made = F.struct(*[canonical(x[f.name], f.dataType).alias(f.name) for f in fields]) if fields else x
        return F.when(x.isNotNull(), made)
    if isinstance(kind, ArrayType):
        return F.transform(x, lambda e: canonical(e, kind.elementType))
    if isinstance(kind, MapType):
        keys = F.array_sort(F.map_keys(x))
        return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), canonical(x[k], kind.valueType).alias("value"))))
    return x


def canonical_row(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Compact JSON of a row, names in order at every level, nulls kept."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cells = [canonical(F.col(f"`{c}`"), kinds[c]).alias(c) for c in sorted(columns or df.columns)]
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})


def canonical_cell(df: DataFrame, column: str) -> Column:
    """Compact JSON of one nested column."""
    return F.to_json(canonical(F.col(f"`{column}`"), df.schema[column].dataType))
