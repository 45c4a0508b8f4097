"""Catalog tables bucketed by the row key (K2, K3, S8, S12): joins and merges on the key move only what is new.

A table's rows lie in ``buckets`` files by a hash of the key, sorted by it. A join on the key reads the stored side as it lies, and
Spark deals only the other side, the batch, into the same buckets: neither promotion nor the error upsert shuffles
what earlier batches have stored. Tables are made and found through the session's catalog; their files lie in its warehouse,
which a cluster shares.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators import upsert
from feedlens.session import materialize
from feedlens.sources import files

BUCKETS = 32


def append(df: DataFrame, table: str, key: str, buckets: int = BUCKETS) -> None:
    """Append rows to a bucketed table, which the first call makes. A table keeps the buckets that it was made with.

    Rows are dealt by bucket before the write, so a bucket gets one file, not one from each task.
    """
    spark = df.sparkSession
    n = bucket_count(spark, table) if files.table_exists(spark, table) else buckets
    (df.repartition(n, key).write.bucketBy(n, key).sortBy(key).mode("append").format("parquet").saveAsTable(table))


def bucket_count(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{table} is not bucketed")
    return int(rows[0]["data_type"])


def stored(spark: SparkSession, table: str) -> DataFrame | None:
    """(S8) The table, or None where the catalog has none."""
    return spark.read.table(table) if files.table_exists(spark, table) else None


def promote_valid(batch: DataFrame, errors: str, key: str) -> DataFrame:
    """(Q7) The batch's rows without a stored error; rows with a NULL key are kept. The stored errors are not moved."""
    known = stored(batch.sparkSession, errors)
    if known is None:
        return batch
    return batch.join(known.hint("merge").select(key).filter(F.col(key).isNotNull()), key, "left_anti")


def new_rows(batch: DataFrame, table: str, key: str) -> DataFrame:
    """The batch's rows whose key the table doesn't hold yet (all with a NULL key): what a replay still has to append."""
    return promote_valid(batch, table, key)


def merge_errors(source: DataFrame, table: str, key: str, msg_col: str = "error_message") -> DataFrame:
    """(U1) Source rows merged with the stored errors of the same keys: rows and messages as ``upsert.upsert_errors`` gives them.

    Only the stored rows of keys that come in are merged, and those without a key (one bucket); they are found by a join in
    which the table lies still.
    """
    known = stored(source.sparkSession, table)
    if known is None:
        return upsert.upsert_errors(None, source, msg_col)
    known = known.select(source.columns)
    touched = _with_keys(known, source, key, "left_semi").unionByName(known.filter(F.col(key).isNull()))
    return upsert.upsert_errors(touched, source, msg_col)


def _with_keys(known: DataFrame, source: DataFrame, key: str, how: str) -> DataFrame:
    """The stored rows whose key is (``left_semi``) or isn't (``left_anti``) among the source's, rows without a key left out."""
    keys = source.select(key).filter(F.col(key).isNotNull()).distinct().hint("merge")
    return known.filter(F.col(key).isNotNull()).join(keys, key, how).select(known.columns)


def upsert_errors(source: DataFrame, table: str, key: str, msg_col: str = "error_message", buckets: int = BUCKETS) -> None:
    """(U1, K3) The error table after the source's errors. Rows of other keys are carried over bucket by bucket, not shuffled.

    The new table is written beside the old one and then takes its name, so a run that breaks off leaves the old one.
    """
    spark = source.sparkSession
    merged = materialize(merge_errors(source, table, key, msg_col))
    known = stored(spark, table)
    if known is None:
        append(merged, table, key, buckets)
        return
    n = bucket_count(spark, table)
    rest = _with_keys(known.select(merged.columns), merged, key, "left_anti")
    fresh = f"{table}_next"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    rest.write.bucketBy(n, key).sortBy(key).format("parquet").saveAsTable(fresh)
    append(merged, fresh, key, n)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table.rsplit('.', 1)[-1]}")
