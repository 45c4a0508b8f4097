"""A form of nested values that can be compared, grouped and joined (J6, X2): maps as sorted entries.

Two maps are the same when they hold the same entries, in whatever order; engines compare maps badly or not at all. Here a map
becomes the array of its entries sorted by key, and everything that holds maps is rebuilt around that; ``restore`` turns it back.
NULL maps stay NULL and differ from empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.ArrayType) and has_map(kind.elementType)


def canonical(value: Column, kind: T.DataType) -> Column:
    """``value`` with every map in it as sorted entries."""
    if not has_map(kind):
        return value
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(
            canonical(e["key"], kind.keyType).alias("key"), canonical(e["value"], kind.valueType).alias("value")))
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: canonical(x, kind.elementType))
    fields = F.struct(*[canonical(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
    return F.when(value.isNotNull(), fields)


def restore(value: Column, kind: T.DataType) -> Column:
    """The value back from its canonical form."""
    if not has_map(kind):
        return value
    if isinstance(kind, T.MapType):
        return F.map_from_entries(F.transform(value, lambda e: F.struct(
            restore(e["key"], kind.keyType).alias("key"), restore(e["value"], kind.valueType).alias("value"))))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: restore(x, kind.elementType))
    fields = F.struct(*[restore(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
    return F.when(value.isNotNull(), fields)
