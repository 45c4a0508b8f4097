"""Message feed decode / encode and key rescue.

Messages use the Kafka-source record shape (``key``/``value`` binary, ``topic``,
``partition``, ``offset``, ``timestamp``), so the same operators serve a topic
read with ``format("kafka")`` where that connector is installed, and the
file-backed feeds used in tests.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def decode(messages: DataFrame, value_schema: T.StructType, prefix: str = "") -> DataFrame:
    """key bytes -> UTF-8 text (NULL stays NULL); value bytes -> parsed struct.

    A malformed value is not dropped: it keeps its topic/partition/offset,
    ``is_valid`` is false and the raw text is kept in ``raw_value``.
    """
    schema = T.StructType(value_schema.fields + [T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = messages.select("topic", "partition", "offset",
                          F.col("key").cast("string").alias("key"),
                          text.alias("raw_value"), parsed.alias("_v"))
    return out.select("topic", "partition", "offset", "key",
                      *[F.col(f"_v.{f.name}").alias(prefix + f.name) for f in value_schema.fields],
                      (F.col("_v").isNotNull() & F.col(f"_v.{CORRUPT}").isNull()).alias("is_valid"),
                      "raw_value")


def encode(records: DataFrame, key_col: str | None, topic: str,
           value_cols: list[str] | None = None) -> DataFrame:
    """Records -> (key, value, topic) with a JSON value, ready for a topic sink."""
    cols = value_cols or [c for c in records.columns if c != key_col]
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return records.select(key.cast("binary").alias("key"),
                          F.to_json(F.struct(*cols)).cast("binary").alias("value"),
                          F.lit(topic).alias("topic"))


_OBJECT = "map<string,variant>"


def unmatched(value: Column, parsed: Column, schema: T.StructType) -> Column:
    """What of a JSON value (VARIANT) isn't in its parsed struct, as map<string,variant>: unknown keys,
    values of another type than the schema's, and the same of nested objects and arrays of objects
    (there NULL stands for elements that match). NULL where the value is no object."""
    return _bound(F.try_variant_get(value, "$", _OBJECT), lambda entries: _unmatched_entries(entries, parsed, schema))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _unmatched_entries(entries: Column, parsed: Column, schema: T.StructType) -> Column:
    none = F.expr(f"cast(map() as {_OBJECT})")
    parts = [F.map_filter(entries, lambda k, _: ~k.isin([f.name for f in schema.fields]))]
    for f in schema.fields:
        parts.append(F.coalesce(_bound(F.try_element_at(entries, F.lit(f.name)), _unmatched_field(f.name, parsed.getField(f.name), f.dataType)), none))
    return F.when(entries.isNotNull(), F.map_concat(*parts))


def _unmatched_field(name: str, got: Column, kind: T.DataType) -> Callable[[Column], Column]:
    return lambda v: F.when(v.isNotNull() & ~F.is_variant_null(v), _unmatched_value(name, got, kind, v))


def _unmatched_value(name: str, got: Column, kind: T.DataType, v: Column) -> Column:
    def entry(x: Column) -> Column:
        return F.create_map(F.lit(name), x)

    if isinstance(kind, T.StructType):
        return _bound(unmatched(v, got, kind), lambda m: F.when(m.isNull(), entry(v)).when(
            F.size(m) > 0, entry(F.to_variant_object(m))))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        def element(x: Column, i: Column) -> Column:
            return _bound(unmatched(x, F.get(got, i), kind.elementType), lambda m: F.when(
                m.isNull() & ~F.is_variant_null(x), x).when(F.size(m) > 0, F.to_variant_object(m)))

        def elements(a: Column) -> Column:
            return F.when(a.isNull(), entry(v)).when(F.exists(a, lambda x: x.isNotNull()), entry(F.to_variant_object(a)))

        return _bound(F.transform(F.try_variant_get(v, "$", "array<variant>"), element), elements)
    return F.when(got.isNull(), entry(v))


# Types of a JSON value, as ``schema_of_variant`` writes them, that a column of each type takes whole.
_TAKES = {T.StringType: r"(?:STRING|BIGINT|BOOLEAN|VOID)", T.LongType: r"(?:BIGINT|VOID)"}


def fitting_pattern(kind: T.DataType) -> str:
    """A pattern for types of JSON values that fit a type for certain (others may fit too)."""
    if isinstance(kind, T.StructType):
        names = sorted(kind.fields, key=lambda f: f.name)
        return "(?:VOID|OBJECT<" + "".join(f"(?:{re.escape(f.name)}: {fitting_pattern(f.dataType)}(?:, |(?=>)))?" for f in names) + ">)"
    if isinstance(kind, T.ArrayType):
        return f"(?:VOID|ARRAY<{fitting_pattern(kind.elementType)}>)"
    return _TAKES.get(type(kind), "VOID")


def rescue(raw: DataFrame, raw_col: str, schema: T.StructType,
           rescued_col: str = "_rescued", object_col: str | None = None) -> DataFrame:
    """Parse ``raw_col`` with ``schema``; what doesn't fit it is kept with its values, as a JSON object
    in ``rescued_col`` (NULL if all fits), instead of failing. ``object_col`` gets whether the text is a JSON object.

    A value's type tells for most rows at once that all fits, and that it is an object; only for the others the rest is worked out."""
    out = raw.withColumns({"_p": F.from_json(F.col(raw_col), schema), "_v": F.try_parse_json(raw_col)}).withColumn("_t", F.schema_of_variant("_v"))
    fits = F.col("_t").rlike(f"^{fitting_pattern(schema)}$")
    if object_col:
        out = out.withColumn(object_col, F.when(F.col("_t").startswith("OBJECT<"), True).otherwise(F.json_object_keys(raw_col).isNotNull()))
    rest = _bound(unmatched(F.col("_v"), F.col("_p"), schema),
                  lambda m: F.when(F.size(m) > 0, F.to_json(F.to_variant_object(m))))
    return (out.withColumn(rescued_col, F.when(~F.coalesce(fits, F.lit(False)), rest)).drop("_v", "_t")
            .select("*", *[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields]).drop("_p"))


def drift(rescued: DataFrame, rescued_col: str = "rescued", day_col: str = "day") -> DataFrame:
    """(S4) Which unknown or mistyped keys arrive: per day and key the rows, their type, and the key's first day.

    The type is that of all the day's values together (``schema_of_variant_agg``: INT and TEXT in one day make VARIANT). Keys are those at the
    top of the rescued objects, nested rests below them show in the type. Rows without a rest say nothing; a
    NULL day is a day. One aggregate, pre-aggregated by task, so a key that every row carries is a row a task and day.
    """
    value = F.try_parse_json(rescued_col)
    entries = rescued.select(F.col(day_col).alias("day"), F.explode(F.map_entries(F.try_variant_get(value, "$", _OBJECT))).alias("e"))
    by_day = (entries.groupBy("day", F.col("e.key").alias("key"))
              .agg(F.count("*").alias("n_rows"), F.schema_of_variant_agg("e.value").alias("type")))
    first = F.min("day").over(Window.partitionBy("key"))
    return by_day.withColumn("first_day", first)
