"""Error-table upsert without MERGE.

Rows are matched on every column except the message, NULL-safely. Instead of a
full outer join, target and source are unioned and grouped by those columns:
grouping treats NULLs as equal, which is exactly ``<=>`` on every column, and
``collect_set`` aggregates map-side so repeated identical rows collapse before
the shuffle. Each group holds at most one target message and the distinct
incoming messages, so it is bounded by the number of rules.

Messages are a set: the target's messages keep their order, new ones are
appended in sorted order, and a message already present is not added again,
so replaying a batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions import canonical

SEP = " | "


def _parts(arr):
    return F.flatten(F.transform(arr, lambda m: F.split(m, r" \| ")))


def _comparable(df: DataFrame) -> DataFrame:
    """``df`` with columns that hold maps in their canonical form."""
    kinds = {f.name: f.dataType for f in df.schema.fields if canonical.has_map(f.dataType)}
    return df.withColumns({c: canonical.canonical(F.col(c), kind) for c, kind in kinds.items()}) if kinds else df


def upsert_errors(target: DataFrame | None, source: DataFrame,
                  msg_col: str = "error_message") -> DataFrame:
    """The target's rows with the source's messages added; columns of any type, maps at any depth included, tell rows apart."""
    keys = [c for c in source.columns if c != msg_col]
    kinds = {f.name: f.dataType for f in source.schema.fields}
    src = _comparable(source).select(*keys, F.col(msg_col).alias("_m"), F.lit(1).alias("_side"))
    if target is None:
        union = src
    else:
        tgt = _comparable(target).select(*keys, F.col(msg_col).alias("_m"), F.lit(0).alias("_side"))
        union = tgt.unionByName(src)
    g = union.groupBy(*keys).agg(
        F.collect_set(F.when(F.col("_side") == 0, F.col("_m"))).alias("_t"),
        F.collect_set(F.when(F.col("_side") == 1, F.col("_m"))).alias("_s"))
    merged = F.array_distinct(F.concat(_parts(F.array_sort("_t")),
                                       F.array_sort(F.array_distinct(_parts("_s")))))
    return g.select(*[canonical.restore(F.col(c), kinds[c]).alias(c) for c in keys], F.array_join(merged, SEP).alias(msg_col))


def distinct_rows(df: DataFrame) -> DataFrame:
    """(X2) Distinct rows, NULLs equal, columns that hold maps compared by their entries."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return _comparable(df).distinct().select(*[canonical.restore(F.col(c), kind).alias(c) for c, kind in kinds.items()])
