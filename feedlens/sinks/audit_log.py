"""Compaction of an audit log (W1, U2): a snapshot of the current state per key, and the events since.

The log is partitioned by what wrote the events (``sinks.tables.write_events``). Compaction folds the writers' partitions that it finds into the
snapshot and then removes them from the log, so a reader of the current state reads the snapshot and the few events
written since, never the whole history. The snapshot is partitioned by a range of key hashes (``bucket``); only ranges that have
new events are read and rewritten.

A compaction can be broken off anywhere and simply run again: it notes the writers it folds before it starts, every
row it writes carries the compaction's number, and a range that carries the number already isn't folded twice. Events written
again under a folded writer's key (a replayed micro-batch) are not counted again. One compaction of a log runs at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.operators import audit
from feedlens.session import materialize
from feedlens.sinks import tables as sinks
from feedlens.sources import files

BUCKETS = 64
KEY = sinks.EVENT_KEY


def _bucket(keys) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket")


class AuditLog:
    """A log at ``path`` with its snapshot beside it (``<path>_snapshot``, ``<path>_folded``).

    schema: of the events; keys: what a state belongs to; carry: what the latest event (by ``seq``) says.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys=audit.BATCH_KEYS, carry=("status", "error_message")):
        self.spark, self.path, self.keys, self.carry = spark, path, list(keys), list(carry)
        self.events = T.StructType([*schema.fields, T.StructField(KEY, T.StringType())])
        types = {f.name: f for f in schema.fields}
        self.state = T.StructType([types[c] for c in (*self.keys, *self.carry, "seq")] + [T.StructField("n_events", T.LongType())])
        self.stored = T.StructType([*self.state.fields, T.StructField("through", T.LongType()), T.StructField("bucket", T.IntegerType())])
        self.noted = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("number", T.LongType())])

    def _snapshot(self) -> DataFrame | None:
        return files.read_if_exists(self.spark, f"{self.path}_snapshot", self.stored)

    def _notes(self, name: str) -> DataFrame:
        found = files.read_if_exists(self.spark, f"{self.path}_{name}", self.noted)
        return self.spark.createDataFrame([], self.noted) if found is None else found

    def unfolded(self) -> DataFrame:
        """The events that no finished compaction has folded."""
        log = files.read_if_exists(self.spark, self.path, self.events)
        log = self.spark.createDataFrame([], self.events) if log is None else log
        return log.join(self._notes("folded").select(KEY), KEY, "left_anti").select(log.columns)

    def _merged(self, states: DataFrame) -> DataFrame:
        latest = F.max_by(F.struct(*self.carry, "seq"), "seq")
        return (states.groupBy(*self.keys).agg(latest.alias("_l"), F.sum("n_events").alias("n_events"))
                .select(*self.keys, *[F.col(f"_l.{c}").alias(c) for c in (*self.carry, "seq")], "n_events"))

    def _delta(self, events: DataFrame) -> DataFrame:
        return audit.current(events, self.keys, carry=self.carry).select(*self.state.names)

    def current(self) -> DataFrame:
        """The latest event per key and the number of events, as ``audit.current`` over the whole log. Not while a compaction runs."""
        delta = self._delta(self.unfolded())
        snapshot = self._snapshot()
        return delta if snapshot is None else self._merged(snapshot.select(*self.state.names).unionByName(delta))

    def compact(self) -> None:
        log = files.read_if_exists(self.spark, self.path, self.events)
        if log is None:
            return
        # left by a compaction that was broken off between its last note and the removal
        sinks.drop_partitions(self.spark, self.path, log.select(KEY).distinct().join(self._notes("folded"), KEY, "left_semi"), [KEY])
        open_ = self._notes("folding").join(self._notes("folded"), "number", "left_anti")
        number = open_.agg(F.max("number")).first()[0]  # one that was broken off goes on with its own list
        if number is None:
            number = (self._notes("folded").agg(F.max("number")).first()[0] or 0) + 1
            writers = self.unfolded().select(KEY).distinct().withColumn("number", F.lit(number).cast("long"))
            sinks.write_partitions(writers, f"{self.path}_folding", ["number"])
        mine = materialize(self._notes("folding").filter(F.col("number") == number))
        if mine.isEmpty():
            return
        log = self.spark.read.schema(self.events).parquet(self.path)
        delta = materialize(self._delta(log.join(mine.select(KEY), KEY, "left_semi")).withColumn("bucket", _bucket(self.keys)))
        touched = delta.select("bucket").distinct()
        snapshot = self._snapshot()
        if snapshot is not None:
            done = snapshot.filter(F.col("through") == number).select("bucket").distinct()
            touched = materialize(touched.join(done, "bucket", "left_anti"))
            old = files.same_partitions(snapshot, touched, "bucket").select(*self.state.names)
            delta = old.unionByName(delta.join(touched, "bucket", "left_semi").select(*self.state.names))
        states = self._merged(delta.select(*self.state.names))
        # computed before the ranges that it is read from are overwritten
        states = materialize(states.withColumns({"through": F.lit(number).cast("long"), "bucket": _bucket(self.keys)}))
        sinks.write_partitions(states, f"{self.path}_snapshot", ["bucket"])
        sinks.write_partitions(mine, f"{self.path}_folded", ["number"])
        sinks.drop_partitions(self.spark, self.path, mine, [KEY])
