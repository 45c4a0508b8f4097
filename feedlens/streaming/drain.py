"""Bounded drain of a message feed into landing files.

The feed has the Kafka-source record shape. Each micro-batch (bounded by
``maxFilesPerTrigger`` here, ``maxOffsetsPerTrigger`` on a Kafka source) becomes one landing
file: the folder ``drain=<query id>-<batch id>/landing_file=post_detail_<drain time>.json``, one message
value a line, written in parts by the tasks that hold them. The query id lives in the checkpoint,
and the drain time is the micro-batch's own time, which Spark keeps in its offset log: a
replayed batch overwrites exactly its folder, and a drain under a new checkpoint gets folders
of its own. With ``availableNow`` the drain stops once the feed is exhausted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedlens import schemas
from feedlens.functions.dates import STAMP_FORMAT
from feedlens.sinks.tables import LANDING_FILE, write_landing_file, write_partitions
from feedlens.streaming.ingest import stream_key

DRAIN, DRAINED_AT = "drain", "_drained_at"


def drain_writer(landing: str, drained_log: str, key, prefix: str = "post_detail_"):
    """foreachBatch callback. ``key(spark, batch_id)`` names the micro-batch for good; the batch carries its time
    in ``DRAINED_AT``. Message counts and offset ranges by source partition go to ``drained_log``; messages without a value (a topic's
    deletions) have nothing to land, and are counted there (``n_null``).

    A micro-batch is one landing file, so its tasks write what they read, without a shuffle. The counts read it once more, which costs less than
    to cache its values."""
    def write(batch: DataFrame, batch_id: int) -> None:
        name = F.concat(F.lit(prefix), F.date_format(DRAINED_AT, STAMP_FORMAT), F.lit(".json")).alias(LANDING_FILE)
        drain_key = key(batch.sparkSession, batch_id)
        valid = batch.filter(F.col("value").isNotNull())
        found = valid.select(name).first()
        if found is not None:
            write_landing_file(valid.select(F.col("value").cast("string").alias("line")),
                               f"{landing}/{DRAIN}={drain_key}/{LANDING_FILE}={found[LANDING_FILE]}")
        counts = batch.groupBy(F.lit(drain_key).alias(DRAIN), name, "topic", "partition").agg(
            F.count("value").alias("n_messages"), F.count_if(F.col("value").isNull()).alias("n_null"),
            F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"))
        write_partitions(counts, drained_log, [DRAIN])
    return write


def drained_counts(log: DataFrame) -> DataFrame:
    """What the drains of a log took from each source partition, a drain counted once however often a batch was replayed."""
    return log.groupBy("topic", "partition").agg(
        F.sum("n_messages").alias("n_messages"), F.sum("n_null").alias("n_null"),
        F.min("min_offset").alias("min_offset"), F.max("max_offset").alias("max_offset"))


def kafka_feed(spark: SparkSession, bootstrap_servers: str, topic: str,
               max_offsets_per_trigger: int = 5_000_000, options: dict | None = None) -> DataFrame:
    """Streaming read of a Kafka topic from the earliest offset, bounded per
    micro-batch. Requires the Spark Kafka connector on the classpath;
    credentials come in through ``options`` (``kafka.*``), never from code."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", "earliest")
              .option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
              .options(**(options or {})))
    try:
        return reader.load()
    except Exception as e:  # noqa: BLE001 - connector missing: say so plainly
        if "kafka" in str(e).lower() and ("not find" in str(e).lower() or "failed to find" in str(e).lower()):
            raise RuntimeError("the Spark Kafka connector is not installed; "
                               "use a file-backed feed with the same record shape") from e
        raise


def file_feed(spark: SparkSession, feed_path: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming read of a parquet-backed feed with the Kafka record shape."""
    return (spark.readStream.schema(schemas.MESSAGE)
            .option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(feed_path))


def drain(feed: DataFrame, landing: str, drained_log: str, checkpoint: str) -> StreamingQuery:
    """Drain any message stream (Kafka or file-backed); stops when nothing is left."""
    known: list[str] = []  # the query's id, read once

    def key(spark: SparkSession, batch_id: int) -> str:
        if not known:
            known.append(stream_key(spark, checkpoint))
        return f"{known[0]}-{batch_id}"

    return (feed.withColumn(DRAINED_AT, F.current_timestamp())
            .writeStream.foreachBatch(drain_writer(landing, drained_log, key))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def start_drain(spark: SparkSession, feed_path: str, landing: str, drained_log: str,
                checkpoint: str, max_files_per_trigger: int = 100) -> StreamingQuery:
    """Drain a parquet-backed message feed; stops when nothing is left."""
    return drain(file_feed(spark, feed_path, max_files_per_trigger), landing, drained_log, checkpoint)


def publish(records: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str | None = None,
            options: dict | None = None):
    """Write encoded records (``key``/``value`` binary, see ``messages.encode``)
    to a Kafka topic: a batch write, or a streaming one when ``records`` is a
    stream (then ``checkpoint`` is required). Needs the Kafka connector."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, **(options or {})}
    cols = records.select("key", "value")
    if records.isStreaming:
        return (cols.writeStream.format("kafka").options(**opts)
                .option("checkpointLocation", checkpoint).start())
    cols.write.format("kafka").options(**opts).save()
    return None
