"""File sources: landing-file names, quarantine, batch readers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions import dates
from feedlens.sinks.tables import CSV_OPTIONS, LANDING_FILE

# File statuses and the quarantine messages.
ACCEPTED, QUARANTINED = "Accepted", "Quarantined"
NAME_MISMATCH = "Filename %s format mismatch"
NOT_PARSED = "File %s holds no post"
PARTLY_PARSED = "File %s: %d elements are no posts"


def _in_folder(p: Column) -> tuple[Column, Column]:
    """The last two names of a path, and whether the first of them is ``landing_file=<name>``."""
    names = F.substring_index(p, "/", -2)
    return names, names.startswith(f"{LANDING_FILE}=") & names.contains("/") & ~names.startswith(f"{LANDING_FILE}=/")


def landing_path(path) -> Column:
    """A landing file's path from that of one of its parts: its folder where it is one (``landing_file=<name>``)."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(p, rf"(^|/){LANDING_FILE}=([^/]+)/[^/]*\z", "$1$2")


def part_name(path) -> Column:
    """The part's own name where a landing file is a folder of parts, else NULL."""
    p = F.col(path) if isinstance(path, str) else path
    return F.when(_in_folder(p)[1], F.substring_index(p, "/", -1))


def with_file_columns(df: DataFrame, path_col: str = "source_file",
                      pattern: str = dates.POST_FILE_PATTERN) -> DataFrame:
    """Add the bronze stamp columns from a full file path."""
    stamp = dates.stamp(path_col, pattern)
    parts = dates.stamp_parts("file_date")
    return (df.withColumn("file_date", stamp)
            .withColumns(parts)
            .withColumns({"filename": dates.file_name(path_col)})
            .withColumns({"batch_ts": dates.batch_ts("file_date")})
            # a name must match whole and carry a real time (no month 13)
            .withColumns({"name_ok": dates.name_matches("filename", pattern)
                          & F.col("batch_ts").isNotNull()}))


def _parsed(batch: DataFrame) -> Column:
    return F.coalesce(F.col("parse_ok"), F.lit(False)) if "parse_ok" in batch.columns else F.lit(True)


def _accepted(batch: DataFrame) -> Column:
    return F.coalesce(F.col("name_ok"), F.lit(False)) & _parsed(batch)


def quarantine_split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows) by whole-name match (K5), and, for
    landing files, by whether the element is a post (``parse_ok``).

    Rejected rows keep their file name (and raw text, where the batch has it) and carry a NULL stamp;
    nothing is moved on the driver -- the rejected frame is written to a quarantine table.
    """
    ok = _accepted(batch)
    rejected = (batch.filter(~ok)
                .withColumns({"file_date": F.lit(None).cast("string"),
                              "batch_ts": F.lit(None).cast("timestamp")}))
    return batch.filter(ok), rejected


def file_report(batch: DataFrame) -> DataFrame:
    """One row per file of a batch (X1): status, business date, batch time, rows, message.

    A file of the right name is accepted if it holds a post; the message then says how many
    of its elements are none.
    """
    name_ok = F.coalesce(F.col("name_ok"), F.lit(False))
    g = (batch.groupBy("source_file", "filename", "file_date", name_ok.alias("_name_ok"))
         .agg(F.count("*").alias("n_rows"), F.min("batch_ts").alias("_ts"),
              F.count_if(~_parsed(batch)).alias("_bad")))
    ok = F.col("_name_ok") & (F.col("_bad") < F.col("n_rows"))
    message = (F.when(~F.col("_name_ok"), F.format_string(NAME_MISMATCH, "filename"))
               .when(~ok, F.format_string(NOT_PARSED, "filename"))
               .when(F.col("_bad") > 0, F.format_string(PARTLY_PARSED, "filename", "_bad")))
    return g.select("source_file", "filename",
                    F.when(ok, ACCEPTED).otherwise(QUARANTINED).alias("status"),
                    F.when(ok, F.to_date("_ts")).alias("business_date"),
                    F.when(ok, F.col("_ts")).alias("batch_ts"),
                    "n_rows", message.alias("error_message"))


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A parquet table at ``path``, or None where nothing has been written yet; any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def same_partitions(stored: DataFrame, batch: DataFrame, column: str | Sequence[str]) -> DataFrame:
    """The stored rows of the partition values (of one column or several) that occur in ``batch``, NULL included.

    The values stay on the executors: an equality semi join, by which Spark prunes the partitions
    read, and for NULL a filter on the partitions that have one.
    """
    if not isinstance(column, str):
        values = batch.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(column)]).distinct()
        no_null = reduce(and_, [F.col(c).isNotNull() for c in column])
        equal = reduce(and_, [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(column)])
        safe = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(column)])
        some_null = ~reduce(and_, [F.col(f"_p{i}").isNotNull() for i in range(len(column))])
        return stored.join(values, equal, "left_semi").unionByName(
            stored.filter(~no_null).join(values.filter(some_null), safe, "left_semi"))
    values = batch.select(column).distinct()
    nulls = values.filter(F.col(column).isNull()).limit(1).select(F.lit(1).alias("_one"))
    of_null = stored.filter(F.col(column).isNull()).withColumn("_one", F.lit(1)).join(nulls, "_one", "left_semi").drop("_one")
    return stored.join(values.filter(F.col(column).isNotNull()), column, "left_semi").select(stored.columns).unionByName(
        of_null.select(stored.columns))


def latest_delivery(bronze: DataFrame) -> DataFrame:
    """The bronze rows of each landing file's latest delivery.

    A file that is delivered again lands as new parts beside the old ones, whose names carry another write's id; the
    delivery whose parts landed last (``landed_at``) counts. A delivery is taken to land at once, as Spark commits a write.
    """
    name = F.regexp_extract("filename", "^([^~]*)", 1)
    delivery = F.regexp_extract("filename", r"~part-\d+-([0-9a-fA-F-]{36})", 1)
    marked = bronze.withColumns({"_file": name, "_delivery": delivery})
    newest = marked.groupBy("_file").agg(F.max_by("_delivery", F.struct("landed_at", "_delivery")).alias("_delivery"))
    return marked.join(newest, ["_file", "_delivery"], "left_semi").select(bronze.columns)


def read_batch(spark: SparkSession, fmt: str, path: str, schema: T.StructType | None = None,
               options: dict | None = None) -> DataFrame:
    """Format dispatch from a registry row (S5-S7). Partition columns in the
    schema keep their declared types; filters on them prune directories."""
    if fmt not in ("json", "csv", "parquet", "text"):
        raise ValueError(f"unsupported format {fmt!r}")
    reader = spark.read.format(fmt)
    opts = dict(CSV_OPTIONS) if fmt == "csv" else {}
    opts.update(options or {})
    reader = reader.options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.load(path)


def registry_row(registry: DataFrame, name: str, source_name: str) -> dict:
    """The single registry row for (name, source) (S9); fails on 0 or >1 rows.

    The registry is a control table; at most two rows are fetched.
    """
    rows = (registry.filter((F.col("name") == name) & (F.col("source_name") == source_name))
            .limit(2).collect())
    if len(rows) != 1:
        raise LookupError(f"expected one registry row for {name}/{source_name}, got {len(rows)}")
    return rows[0].asDict()


def table_exists(spark: SparkSession, name: str) -> bool:
    """(S12) catalog lookup instead of SHOW TABLES + count."""
    return spark.catalog.tableExists(name)


def read_registered_batch(spark: SparkSession, registry_row: dict, business_date: str,
                          schema: T.StructType | None = None) -> DataFrame:
    """One day's batch of a registered dataset.

    The registry row names the format and the bronze path. The day is
    selected with filters on the typed partition columns (year / month / day
    strings), which Spark turns into directory pruning, instead of building
    ``bronze/y/m/d/*/`` paths by hand.
    """
    y, m, d = business_date[:4], business_date[5:7], business_date[8:10]
    df = read_batch(spark, registry_row["format"], registry_row["bronze_path"], schema)
    return df.filter((F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d))
