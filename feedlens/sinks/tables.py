"""Table sinks (K1-K6): partitioned, replay-safe writes.

Replays are made harmless by dynamic partition overwrite: rewriting a batch
replaces exactly the partitions it touches (bronze by file, gold by date),
instead of appending duplicates. Rows are rebalanced by the partition columns
before a write, so a partition gets files by its size, not one from each task; Spark splits
a large partition over several tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A quote inside a value is doubled and line breaks may stand in quotes, so JSON text survives.
CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true"}
BRONZE_PARTITIONS = ["year", "month", "day", "filename"]
#: Shuffled (compressed) bytes that a task of a write gets at most, but for what one task before it made of a partition: the task sorts
#: them by partition, and texts that repeat themselves take many times their compressed size.
WRITE_BYTES = 8 << 20
#: Rows of a csv file: quoted line breaks keep a csv file from being split, so one task reads all of it.
CSV_FILE_ROWS = 100_000

_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def write_sizes(spark: SparkSession) -> Iterator[None]:
    """Rebalanced writes in here get ``WRITE_BYTES`` a task, or what the session says if that is less."""
    given = spark.conf.get(_ADVISORY)
    spark.conf.set(_ADVISORY, str(min(_bytes(given), WRITE_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(_ADVISORY, given)


def clustered(df: DataFrame, by: list[str]) -> DataFrame:
    return df.hint("rebalance", *by)


def write_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet",
                     options: dict | None = None) -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are replaced."""
    with write_sizes(df.sparkSession):
        (clustered(df, partition_by).write.format(fmt).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .options(**(options or {}))
         .partitionBy(*partition_by).save(path))


def write_bronze(batch: DataFrame, path: str, fmt: str = "json") -> None:
    """(K1) one write per micro-batch, laid out year/month/day/filename."""
    if fmt == "csv":  # csv holds no nested values
        batch = batch.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.StructType, T.ArrayType))
                               else F.col(f.name) for f in batch.schema.fields])
    write_partitions(batch, path, BRONZE_PARTITIONS, fmt,
                     {**CSV_OPTIONS, "maxRecordsPerFile": str(CSV_FILE_ROWS)} if fmt == "csv" else None)


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """(K2) plain append (audit trails, silver when batches never repeat)."""
    w = df.write.format(fmt).mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_gold(df: DataFrame, path: str, partition_col: str = "comment_date",
               only_present: bool = False) -> None:
    """(K4) gold table partitioned by date. Full replace by default; with
    ``only_present`` just the dates in ``df`` are rewritten. Rows are
    clustered by the partition column first so each date gets few files."""
    w = (clustered(df, [partition_col]).write.format("parquet").mode("overwrite")
         .partitionBy(partition_col))
    if only_present:
        w = w.option("partitionOverwriteMode", "dynamic")
    else:
        w = w.option("partitionOverwriteMode", "static")
    w.save(path)


EVENT_KEY = "event_key"


def write_events(events: DataFrame, path: str, key: str) -> None:
    """(M5, U2) Audit events under the key of what wrote them, each exactly once.

    The log is partitioned by the key, and a key's events are replaced: a micro-batch or job step that is run again under its
    key leaves as many events as before. All writers of one log go through here, so its layout is one.
    """
    write_partitions(events.withColumn(EVENT_KEY, F.lit(key)), path, [EVENT_KEY])


def drop_partitions(spark: SparkSession, path: str, values: DataFrame, columns: list[str]) -> None:
    """Remove the folders of some partitions of the table at ``path``; those that aren't there are passed over.

    ``values`` is a control frame (batches), collected here. A dynamic overwrite replaces only partitions that
    get rows, so a batch that is left without any needs this.
    """
    jvm = spark._jvm  # Spark's own naming of partition folders, and the file system of the path
    name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    conf = spark._jsc.hadoopConfiguration()
    for row in values.select(*[F.col(c).cast("string") for c in columns]).distinct().collect():
        folder = jvm.org.apache.hadoop.fs.Path("/".join([path, *[name(c, v) for c, v in zip(columns, row)]]))
        folder.getFileSystem(conf).delete(folder, True)


LANDING_FILE = "landing_file"


def write_landing(lines: DataFrame, landing: str, by: tuple[str, ...] = (LANDING_FILE,)) -> None:
    """(K6) Rows (``line``, partition columns) as text below ``<landing>/.../landing_file=<name>/``.

    A landing file of any size is one folder that carries its name, written in parts by
    the tasks that hold its rows; each part appears whole. Rewriting the same folders
    replaces them. Line breaks inside a line (white space in JSON) become spaces.
    """
    write_partitions(_flat(lines).select("line", *by), landing, list(by), "text")


def write_landing_file(lines: DataFrame, folder: str) -> None:
    """(K6) Rows (``line``) as text in the folder of one landing file: each task writes what it holds, in no order, so none
    sorts or shuffles it. What the folder had is replaced."""
    _flat(lines).select("line").write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(folder)


def _flat(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line", F.regexp_replace("line", "[\\r\\n]+", " "))
