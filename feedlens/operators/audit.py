"""Append-only audit trail.

The reference updates audit rows in place. Here every status change is an
appended event ``(key..., seq, status, error_message)`` and the current state
is derived: ``max_by`` over ``seq`` per key. ``max_by`` aggregates map-side,
so a key holding a third of all events is reduced before the shuffle (a
row_number window would pull the whole key into one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import schemas

#: A batch of a dataset: feeds arrive several times a day, so the batch time is part of the
#: key; the business date is its calendar day and comes along.
BATCH_KEYS = ("dataset_id", "batch_ts", "business_date")

# Status lifecycle -> (phase, terminal?).
LIFECYCLE = {
    "Started": ("ingest", False),
    "In-Progress": ("ingest", False),
    "Success": ("ingest", True),
    "Failed": ("ingest", True),
    "Validated": ("validation", True),
    "Validation Failed": ("validation", True),
    "Validation Passed": ("rule", True),
    "Skipped": ("aggregation", True),
}


def phase(status="status") -> Column:
    s = F.col(status) if isinstance(status, str) else status
    return F.coalesce(*[F.when(s == k, F.lit(v[0])) for k, v in LIFECYCLE.items()], F.lit("unknown"))


def is_terminal(status="status") -> Column:
    s = F.col(status) if isinstance(status, str) else status
    return s.isin([k for k, v in LIFECYCLE.items() if v[1]])


def audit_events(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Build dataset-audit events (see ``schemas.DATASET_AUDIT``) from tuples."""
    return spark.createDataFrame(rows, schemas.DATASET_AUDIT)


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def event(dataset_id: int, business_date, status: str, error_message: str | None = None,
          seq: Column | None = None, batch_ts=None) -> list[Column]:
    """Columns of one audit event; seq defaults to the commit clock in microseconds.
    The status must be one of LIFECYCLE (``current_status`` relies on it)."""
    if status not in LIFECYCLE:
        raise ValueError(f"unknown audit status {status!r}")
    return [F.lit(dataset_id).cast("int").alias("dataset_id"),
            _col(business_date).cast("date").alias("business_date"),
            _col(batch_ts).cast("timestamp").alias("batch_ts"),
            (seq if seq is not None else F.unix_micros(F.current_timestamp())).alias("seq"),
            F.lit(status).alias("status"),
            F.lit(error_message).cast("string").alias("error_message"),
            F.current_user().alias("actor"),
            F.current_timestamp().alias("at")]


def current(events: DataFrame, keys=BATCH_KEYS,
            seq: str = "seq", carry=("status", "error_message")) -> DataFrame:
    """Latest event per key (W1), plus the number of events seen for it."""
    latest = F.max_by(F.struct(*[F.col(c) for c in carry], F.col(seq).alias(seq)), F.col(seq))
    return (events.groupBy(*keys)
            .agg(latest.alias("_l"), F.count("*").alias("n_events"))
            .select(*keys, *[F.col(f"_l.{c}").alias(c) for c in (*carry, seq)], "n_events"))


def current_status(events: DataFrame, keys=BATCH_KEYS,
                   seq: str = "seq", statuses=tuple(LIFECYCLE)) -> DataFrame:
    """Latest status per key, for views that need only the status.

    The status is aggregated as its index in ``statuses`` -- a fixed-width
    value -- so Spark uses a hash aggregate instead of the sort aggregate that
    a string ``max_by`` needs (about 3x faster on 3M events). Statuses are
    the lifecycle enum, which every feedlens audit writer uses.
    """
    code = F.coalesce(*[F.when(F.col("status") == s, F.lit(i)) for i, s in enumerate(statuses)])
    names = F.array(*[F.lit(s) for s in statuses])
    return (events.groupBy(*keys)
            .agg(F.max_by(code, F.col(seq)).alias("_c"), F.max(seq).alias(seq),
                 F.count("*").alias("n_events"))
            .select(*keys, F.element_at(names, F.col("_c") + 1).alias("status"), seq, "n_events"))


def lifecycle_summary(current_state: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Per key and current status: lifecycle phase, terminal flag and batch count."""
    return (current_state.groupBy(key, "status")
            .agg(F.count("*").alias("n_batches"))
            .withColumns({"phase": phase("status"), "is_terminal": is_terminal("status")}))


#: A run of one aggregation over one batch: a dataset's aggregations are done, and fail, one by one.
AGGREGATION_KEYS = ("dataset_id", "aggregation_name", "batch_ts")


def not_yet_done(requested: DataFrame, current_state: DataFrame,
                 keys=AGGREGATION_KEYS, done_status: str = "Success", since: str | None = None) -> DataFrame:
    """Guard (G1): requested keys without a ``done_status`` audit (left anti; NULL keys match NULL).

    With ``since``, a column of ``requested`` on the audit's clock (``seq``), an older audit counts for nothing: a batch that has been
    validated anew is asked for again.
    """
    done = current_state.filter(F.col("status") == done_status).select(
        *[F.col(k).alias(f"_{k}") for k in keys], *([F.col("seq").alias("_seq")] if since else []))
    same = [requested[k].eqNullSafe(done[f"_{k}"]) for k in keys]
    if since:
        same.append(done["_seq"] >= requested[since])
    return requested.join(done, same, "left_anti")
