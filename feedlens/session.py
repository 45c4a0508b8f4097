"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the engine relies on. UTC keeps date derivation stable; ANSI stays
# on (Spark 4 default) and every parse or division that may fail uses try_*.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "feedlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide shared folder named by ``spark.checkpoint.dir``.

    Only a local session may name none: it gets a folder under the system temp dir. On a
    cluster such a folder would be each machine's own, so there the setting is required.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = os.path.join(os.environ.get("TMPDIR", "/tmp"), "feedlens-checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path inside the shared folder."""
    return f"{shared_dir(spark)}/feedlens/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Compute a frame once and cut its lineage with a reliable checkpoint in
    the shared checkpoint folder (survives executor loss; never a local one).

    For control-plane frames that a plan reads several times."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a control frame (batches, failing keys) that may go to every task.
SMALL_ROWS = 100_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A materialized frame, marked to be broadcast if it holds at most so many rows (it is counted); a larger one is joined by shuffles.

    Spark can't tell the size of a frame read back from a checkpoint, and would move the other side, the data."""
    return F.broadcast(df) if df.count() <= rows else df
