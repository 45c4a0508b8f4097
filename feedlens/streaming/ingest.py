"""Landing files -> bronze with Structured Streaming.

A landing file is a file of the registered name, or a folder ``landing_file=<name>`` of
parts (as a drain writes). Its text is read in one of two layouts:

* ``json``: any JSON text over several lines: an array of posts, an array of such arrays, a
  single post, or one post a line. Files of any size are read by many tasks (``sources.json_split``);
* ``lines``: one JSON value a line (a post, or an array as above). Nothing larger than a line is held,
  so files may have any size.

Spark bounds the files of a micro-batch by bytes. ``parse_landing`` also takes ``whole`` texts, one a row.

Elements are exploded to one row per post and parsed with the explicit post schema; what doesn't fit it
(unknown keys at any level, values of another type) is kept in ``_rescued`` as JSON. Elements that
are no JSON object go to quarantine with their text, and so does a text that can't be read as JSON at all.

Per micro-batch (``foreachBatch``) there is exactly one bronze write (dynamic
partition overwrite by year/month/day/filename, so a replayed batch rewrites
the same partitions instead of duplicating them), one quarantine write (by batch and file),
and one audit write per phase, under the micro-batch's key, so that a replay leaves no further events.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedlens import schemas
from feedlens.functions import dates
from feedlens.sinks import tables as sinks
from feedlens.sources import files, json_split
from feedlens.sources.messages import rescue

NESTED_SHAPE = r"^\s*\[\s*\["
LAYOUTS = ("json", "lines", "whole")
#: Bytes of landing files in a micro-batch, unless the caller says otherwise.
MAX_BYTES_PER_TRIGGER = 4 << 30


@dataclass
class IngestPaths:
    landing: str
    bronze: str
    quarantine: str
    audit: str
    checkpoint: str
    archive: str | None = None


def stream_key(spark: SparkSession, checkpoint: str) -> str:
    """The streaming query's id, which Spark keeps in its checkpoint: the same after a restart, another
    for a new checkpoint. With a batch id it names a micro-batch for good."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def elements(value: Column, layout: str) -> Column:
    """The raw elements of a landing text; a text that isn't JSON is one element."""
    array = F.when(value.rlike(NESTED_SHAPE), F.flatten(F.from_json(value, "array<array<string>>"))).otherwise(
        F.from_json(value, "array<string>"))
    whole = F.array(value)
    if layout == "whole":  # one object, or one a line
        by_line = F.filter(F.split(value, "\n"), lambda line: F.trim(line) != "")
        whole = F.when(value.rlike(r"^\s*\{") & F.json_object_keys(value).isNull(), by_line).otherwise(whole)
        whole = F.when(value.rlike(r"^\s*\{\s*") & (F.size(by_line) > 1) & F.forall(
            by_line, lambda line: F.json_object_keys(line).isNotNull()), by_line).otherwise(whole)
    return F.when(value.rlike(r"^\s*\["), F.coalesce(array, whole)).otherwise(whole)


def parse_landing(raw: DataFrame, pattern: str = dates.POST_FILE_PATTERN, layout: str = "whole",
                  cached: list[DataFrame] | None = None) -> DataFrame:
    """(value, source_file) rows -> one row per post + file columns; ``_raw`` keeps the text of what is no post.

    In the ``json`` layout the rows are pieces (``json_split.PIECE``), which only a batch can put together.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    landed = F.col("landed_at") if "landed_at" in raw.columns else F.lit(None).cast("string")
    if layout == "json":
        texts = json_split.split_elements(raw.withColumn("landed_at", landed), cached, keep=("landed_at",))
    else:
        text = raw.filter(F.trim("value") != "") if layout == "lines" else raw
        texts = text.select("source_file", landed.alias("landed_at"), F.explode(elements(F.col("value"), layout)).alias("_raw"))
    posts = texts.select(files.landing_path("source_file").alias("source_file"), files.part_name("source_file").alias("part"), "landed_at", "_raw")
    parsed = rescue(posts, "_raw", schemas.POST, object_col="parse_ok")
    # ``part`` stays apart from the file's name: a micro-batch may hold some parts of a landing file only
    return files.with_file_columns(parsed.select(
        *schemas.POST_FIELDS, "_rescued", "source_file", "part", "landed_at", "parse_ok",
        F.when(~F.col("parse_ok"), F.col("_raw")).alias("_raw")), pattern=pattern)


def landing_stream(spark: SparkSession, landing: str, archive: str | None = None,
                   max_files_per_trigger: int | None = None,
                   pattern: str = dates.POST_FILE_PATTERN, layout: str = "json",
                   max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER) -> DataFrame:
    """Landing files as a stream: parsed rows, but for the ``json`` layout, whose pieces a micro-batch parses."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if layout == "json":
        reader = reader.option("lineSep", "}")
    if max_files_per_trigger:  # Spark takes one of the two bounds
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    else:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if archive:
        # a file is archived once the batch after the one that read it commits
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    raw = reader.load(landing)
    if layout == "json":
        return raw.select(*json_split.piece_columns(), landed_at())
    return parse_landing(raw.select("value", F.col("_metadata.file_path").alias("source_file"), landed_at()), pattern, layout)


def landed_at() -> Column:
    """When a landing file (or part) was written, as text that sorts by time."""
    return F.date_format("_metadata.file_modification_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("landed_at")


def audit_rows(report: DataFrame, dataset_id: int, status_ok: str, phase_rank: int) -> DataFrame:
    ok = F.col("status") == files.ACCEPTED
    return report.select(
        F.lit(dataset_id).cast("int").alias("dataset_id"),
        F.col("business_date"),
        F.col("batch_ts"),
        # same clock as the other jobs' audit events, so events of all jobs order
        # by time; the phase orders Started before In-Progress within one append
        (F.unix_micros(F.current_timestamp()) + phase_rank).alias("seq"),
        F.when(ok, F.lit(status_ok)).otherwise(F.lit("Failed")).alias("status"),
        F.col("error_message"),
        F.current_user().alias("actor"),
        F.current_timestamp().alias("at"),
        F.col("filename"))


def bronze_writer(paths: IngestPaths, dataset_id: int, fmt: str = "json", pattern: str = dates.POST_FILE_PATTERN,
                  layout: str = "lines"):
    """The foreachBatch callback (M1, M3, M4, M5, K1, K5)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        cached: list[DataFrame] = []
        if layout == "json":
            batch = parse_landing(batch, pattern, layout, cached)
        batch = batch.persist()  # read the files once for all the writes below
        try:
            if batch.isEmpty():  # M4
                return
            report = files.file_report(batch).persist()
            # Started and In-Progress for each accepted file, in one append; a
            # rejected file gets a single Failed event with the reason
            started = report.filter(F.col("status") == files.ACCEPTED)
            batch_key = f"{stream_key(batch.sparkSession, paths.checkpoint)}-{batch_id}"
            sinks.write_events(audit_rows(started, dataset_id, "Started", 0).unionByName(
                audit_rows(started, dataset_id, "In-Progress", 1)), paths.audit, f"{batch_key}-started")
            accepted, rejected = files.quarantine_split(batch)
            name = F.concat_ws("~", "filename", "part").alias("filename")
            cols = [c for c in accepted.columns if c not in ("batch_ts", "name_ok", "parse_ok", "part", "filename", "_raw")]
            key = F.lit(batch_key).alias("ingest_batch")
            try:
                sinks.write_bronze(accepted.select(*cols, name), paths.bronze, fmt)
                sinks.write_partitions(rejected.select(*cols, "_raw", key, name), paths.quarantine,
                                       ["ingest_batch", "filename"], "json")
                sinks.write_events(audit_rows(report, dataset_id, "Success", 2), paths.audit, f"{batch_key}-done")
            except Exception as e:  # noqa: BLE001 - record, then surface
                failed = report.withColumn("status", F.lit("Failed")).withColumn(
                    "error_message", F.lit(str(e)[:2000]))
                sinks.write_events(audit_rows(failed, dataset_id, "Failed", 2), paths.audit, f"{batch_key}-failed")
                raise
            finally:
                report.unpersist()
        finally:
            for frame in (batch, *cached):
                frame.unpersist()
    return write


def start_ingest(spark: SparkSession, paths: IngestPaths, dataset_id: int, fmt: str = "json",
                 available_now: bool = True, processing_time: str | None = None,
                 max_files_per_trigger: int | None = None, pattern: str = dates.POST_FILE_PATTERN,
                 layout: str = "json", max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER) -> StreamingQuery:
    """Start landing -> bronze. ``available_now`` processes what is there and stops."""
    stream = landing_stream(spark, paths.landing, paths.archive, max_files_per_trigger, pattern, layout,
                            max_bytes_per_trigger)
    w = (stream.writeStream.foreachBatch(bronze_writer(paths, dataset_id, fmt, pattern, layout))
         .option("checkpointLocation", paths.checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def read_bronze(spark: SparkSession, bronze: str, fmt: str = "json") -> DataFrame:
    """Batch read of bronze with its partition columns typed as strings (S5); nested columns of a csv bronze are parsed back."""
    if fmt != "csv":
        return spark.read.format(fmt).schema(schemas.BRONZE).load(bronze)
    nested = {f.name: f.dataType for f in schemas.BRONZE.fields if not isinstance(f.dataType, T.StringType)}
    flat = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.BRONZE.fields])
    return spark.read.format("csv").options(**sinks.CSV_OPTIONS).schema(flat).load(bronze).select(
        *[F.from_json(c, nested[c]).alias(c) if c in nested else F.col(c) for c in flat.names])
