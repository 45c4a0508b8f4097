"""End-to-end jobs: ingest (A), validate and promote (B), aggregate (C).

Each job is a few DataFrame writes; the only values that reach the driver
are control rows (registry row, pending rules), never the data itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens import schemas
from feedlens.functions import dates
from feedlens.functions.rules import Rule
from feedlens.operators import flatten, quality, reports, row_rules, rulesets, sentiment, upsert
from feedlens.sinks import tables as sinks
from feedlens.sources import files
from feedlens.streaming.ingest import IngestPaths, start_ingest, stream_key


def ingest(spark: SparkSession, paths: IngestPaths, dataset_id: int, fmt: str = "json",
           timeout_s: int | None = None, **options) -> None:
    """(A) landing -> bronze, processing what is available, then stop; ``options`` as for ``start_ingest``."""
    q = start_ingest(spark, paths, dataset_id, fmt, available_now=True, **options)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("ingest did not finish in time")
    if q.exception() is not None:
        raise q.exception()


def ingest_registered(spark: SparkSession, registry: DataFrame, name: str, source_name: str, audit: str,
                      checkpoint: str, timeout_s: int | None = None) -> IngestPaths:
    """(A) for a dataset as registered (S9): its row names the paths, the file-name pattern, the landing
    layout (``file_name`` ends in ``.lines`` for one value a line) and the bronze format."""
    row = files.registry_row(registry, name, source_name)
    paths = IngestPaths(landing=row["source_path"], bronze=row["bronze_path"], quarantine=row["unknown_file_path"],
                        audit=audit, checkpoint=checkpoint, archive=row["archive_path"])
    ingest(spark, paths, row["id"], row["format"], timeout_s, pattern=row["file_name_format"],
           layout="lines" if (row["file_name"] or "").endswith(".lines") else "json")
    return paths


def validate(spark: SparkSession, batch: DataFrame, rules: list[Rule], key: str,
             error_table: str, silver: str, batch_col: str = "file_date", tables: Mapping[str, DataFrame] | None = None) -> dict:
    """(B) one pass of all rules -> error table (incremental upsert by batch)
    + silver rows (dynamic overwrite by batch).

    Returns the error-table path, the silver path (None when not promoted),
    the rule outcomes (a small frame) and the rules that could not run. A
    batch is promoted only when every rule ran, as the reference promotes
    only once nothing is pending, and against *all* stored errors of the batch: a
    row that an earlier run rejected stays out when only the remaining rules run later.
    ``tables`` are those that reference rules name.
    """
    from feedlens.functions.rules import missing_rules

    batch = batch.persist()
    try:
        missing = missing_rules(rules, batch.schema)
        marked = row_rules.mark(batch, rules, tables)
        if rules:
            upsert_error_table(spark, row_rules.unmark(quality.error_rows(marked, rules), rules), error_table, batch_col)
        promoted = None
        if not missing:
            sinks.write_partitions(promotable(spark, batch, key, error_table, batch_col), silver, [batch_col])
            promoted = silver
        outcomes = quality.rule_outcomes(marked, rules)
        return {"errors": error_table, "silver": promoted, "outcomes": outcomes, "missing": missing}
    finally:
        batch.unpersist()


def promotable(spark: SparkSession, batch: DataFrame, key: str, error_table: str, batch_col: str) -> DataFrame:
    """The batch's rows without any stored error of their batch."""
    schema = T.StructType([f for f in batch.schema.fields if f.name in (key, batch_col)])
    recorded = files.read_if_exists(spark, error_table, schema)
    if recorded is None:
        return batch
    return quality.promote_valid(batch, files.same_partitions(recorded, batch, batch_col), key)


def refresh_gold(spark: SparkSession, silver: DataFrame, gold: str,
                 text_col: str = "comment_message", only_present_dates: bool = False) -> None:
    """(C / R11) silver comments -> score -> daily NPS/CSAT -> gold by comment_date."""
    daily = reports.daily_nps_csat(reports.enrich(sentiment.score(silver, text_col)))
    sinks.write_gold(daily, gold, "comment_date", only_present=only_present_dates)


def read_gold(spark: SparkSession, gold: str) -> DataFrame:
    """The daily gold table; dates whose comments have all been taken back hold zero rows, which are left out."""
    return spark.read.schema(schemas.DAILY_KPI).parquet(gold).filter("total_comments > 0")


def read_trend(spark: SparkSession, gold: str) -> DataFrame:
    """The gold table of label counts by day, without zero rows."""
    return spark.read.schema("comment_date date, sentiment_label string, count bigint").parquet(gold).filter("count > 0")


# ---- entry B as a whole: pending rules -> one pass -> audits --------------------------
def rules_from_pending(pending: DataFrame) -> list[Rule]:
    """Pending-rule rows of one batch -> rules. This is a control frame (one
    row per active rule of a dataset), the only thing collected here."""
    rows = (pending.select("dcv_id", "column_name", "validation_name", "column_datatype",
                           "validation_parameters").distinct().collect())
    return [Rule(int(r["dcv_id"]), r["column_name"], r["validation_name"], r["column_datatype"],
                 r["validation_parameters"]) for r in rows]


def validate_and_audit(spark: SparkSession, batch: DataFrame, pending: DataFrame, key: str,
                       error_base: str, silver: str, rule_audit: str, dataset_audit: str,
                       dataset_id: int, batch_ts: str, batch_col: str = "file_date") -> str:
    """Validate one batch with its pending rules and record the outcome.

    ``batch_ts`` is the batch's time (its business date is the day of it). Rule audit rows
    get ``Validation Passed`` (with their error counts); the dataset gets ``Validated``, or
    ``Validation Failed`` with the error text when a step raises. Returns the dataset status.
    """
    from feedlens.operators import audit as audit_ops

    seq = F.unix_micros(F.current_timestamp())
    ts = F.lit(batch_ts).cast("timestamp")
    run = uuid.uuid4().hex

    def record(status: str, message: str | None) -> None:
        sinks.write_events(spark.range(1).select(*audit_ops.event(
            dataset_id, F.to_date(ts), status, message, batch_ts=ts)), dataset_audit, f"validation-{run}")

    try:
        out = validate(spark, batch, rules_from_pending(pending), key, error_base, silver, batch_col)
        sinks.write_events(out["outcomes"].select(
            F.col("dcv_id").alias("dataset_column_validation_id"), F.to_date(ts).alias("business_date"),
            ts.alias("batch_ts"), seq.alias("seq"), F.col("status"),
            F.when(F.col("n_errors").isNull(), F.col("result"))
             .otherwise(F.concat(F.col("n_errors").cast("string"), F.lit(" error rows")))
             .alias("error_message")), rule_audit, f"validation-{run}")
    except Exception as e:  # noqa: BLE001 - recorded in the audit, then re-raised
        record("Validation Failed", str(e)[:2000])
        raise
    if out["missing"]:  # some rules could not run: not promoted, retried next time
        record("Validation Failed", "; ".join(f"Column {r.column} not found" for r in out["missing"]))
        return "Validation Failed"
    record("Validated", None)
    return "Validated"


# ---- entry B over every pending batch ---------------------------------------------------------
def validate_pending(spark: SparkSession, rows: DataFrame, to_validate: DataFrame, pending: DataFrame, key: str,
                     errors: str, silver: str, rule_audit: str, dataset_audit: str,
                     tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Validate every pending batch of every dataset in one job, and record the outcomes.

    ``rows`` are the bronze rows of the datasets of one layout, with ``dataset_id``, ``batch_ts`` and ``file_date`` (the batch's stamp);
    ``to_validate`` and ``pending`` come from ``planning``. The number of jobs doesn't depend on the number of batches:
    failing rows are found in one scan and staged, merged into the error table (by dataset and batch), counted
    into rule outcomes; then the rows of batches whose rules have all run, and that have no stored error, go to silver
    (by dataset and batch). A batch with a rule that can't run (missing column), or without rows, is ``Validation Failed`` and stays
    out of silver. Errors and silver of a batch that was delivered again (``pending.rerun``) are dropped first.
    Batches are named by their time, so ``to_validate`` must hold none without.
    Returns one row a batch: dataset_id, batch_ts, business_date, status, error_message.
    """
    from feedlens.session import materialize, scratch_path, small

    where = ["dataset_id", "file_date"]
    checks = rulesets.distinct_checks(pending)
    rules = materialize(rulesets.numbered(pending, checks))
    batches = materialize(rulesets.batches_with_rules(to_validate, rules)
                          .withColumn("file_date", F.date_format("batch_ts", dates.STAMP_FORMAT)))
    again = batches.join(rules.filter("rerun"), list(rulesets.BATCH), "left_semi")
    for path in (errors, silver):
        sinks.drop_partitions(spark, path, again, where)

    staged = scratch_path(spark, "failing_rows")
    rulesets.failing_rows(rows, batches, checks, tables).write.parquet(staged)
    failing = spark.read.parquet(staged)
    if not failing.isEmpty():
        upsert_error_table(spark, failing.drop("failed_rules", "batch_ts"), errors, where)
    present = materialize(rows.select(*rulesets.BATCH).join(small(batches), list(rulesets.BATCH), "left_semi").distinct())
    results = materialize(rulesets.outcomes(rules, checks, failing, present, rows.schema))

    not_run = (results.filter(F.col("status") == quality.FAILED).groupBy(*rulesets.BATCH)
               .agg(F.array_join(F.array_sort(F.collect_set("result")), "; ").alias("_not_run")))
    reason = F.when(F.col("_present").isNull(), F.lit("Batch has no rows")).otherwise(F.col("_not_run"))
    states = materialize(batches.join(present.withColumn("_present", F.lit(True)), list(rulesets.BATCH), "left")
                         .join(not_run, list(rulesets.BATCH), "left")
                         .select(*rulesets.BATCH, "business_date", "file_date",
                                 F.when(reason.isNull(), "Validated").otherwise("Validation Failed").alias("status"),
                                 reason.alias("error_message")))

    done = states.filter("status = 'Validated'").select(*where)
    valid = rows.join(small(done), where, "left_semi").drop("batch_ts")
    stored = files.read_if_exists(spark, errors, T.StructType([f for f in rows.schema.fields if f.name in (key, *where)]))
    if stored is not None:
        bad = files.same_partitions(stored, done, where).filter(F.col(key).isNotNull()).select(key, *where)
        valid = valid.join(bad, [key, *where], "left_anti")
    sinks.write_partitions(valid.select([c for c in rows.columns if c != "batch_ts"]), silver, where)

    run, seq = uuid.uuid4().hex, F.unix_micros(F.current_timestamp())
    told = F.when(F.col("n_errors").isNull(), F.col("result")).otherwise(F.concat(F.col("n_errors").cast("string"), F.lit(" error rows")))
    sinks.write_events(results.select(F.col("dcv_id").alias("dataset_column_validation_id"), "business_date", "batch_ts",
                                      seq.alias("seq"), "status", told.alias("error_message")), rule_audit, f"validation-{run}")
    sinks.write_events(states.select("dataset_id", "business_date", "batch_ts", seq.alias("seq"), "status", "error_message",
                                     F.current_user().alias("actor"), F.current_timestamp().alias("at")),
                       dataset_audit, f"validation-{run}")
    return states.drop("file_date")


# ---- entry C as a whole: every ready aggregation, with its audit ---------------------------
@dataclass(frozen=True)
class Report:
    """A gold report whose counts add up over batches: grouping keys (the comment date first), counts, and the final columns."""

    keys: tuple[str, ...]
    counts: Callable[[DataFrame, tuple[str, ...]], DataFrame]
    sums: tuple[str, ...]
    finish: Callable[[DataFrame], DataFrame]


#: The report of each registered aggregation (by name).
REPORTS = {
    "daily_kpi": Report(("comment_date",), reports.daily_counts, tuple(reports.DAILY_COUNTS), reports.with_ratios),
    "sentiment_trend": Report(("comment_date", "sentiment_label"), reports.label_counts, ("count",), lambda df: df),
}


def fold_partials(spark: SparkSession, enriched: DataFrame, report: Report, partials: str, gold: str,
                  batches: DataFrame | None = None) -> None:
    """Fold enriched comments, with the ``batch_key`` they came in, into a gold report.

    The batches' partial counts are stored by comment date and ``batch_key`` (dynamic overwrite, so a batch
    that is run again replaces its partials instead of adding them twice). The dates that a batch has ever touched stand in
    ``<partials>_dates``, by batch; for those it touches no more it writes zero counts, which takes its
    old ones back. ``batches`` (``batch_key``) names the batches folded, also those that hold no comment now. Gold is rewritten
    only for the touched dates, NULL (an unparsable time) among them, as the sum of all batches' partials of
    those dates; as partials are partitioned by date first, only those are read. A date left without comments keeps zero rows,
    which ``read_gold`` leaves out. The dates are recorded first, so a run that was broken off is simply run again.
    """
    from feedlens.session import materialize

    part = materialize(report.counts(enriched, ("batch_key", *report.keys)))
    touches = part.select("batch_key", "comment_date").distinct()
    folded = touches.select("batch_key").distinct() if batches is None else batches.select("batch_key").distinct()
    known = files.read_if_exists(spark, f"{partials}_dates", touches.schema)
    if known is not None:
        touches = known.join(folded, "batch_key", "left_semi").select(touches.columns).unionByName(touches).distinct()
    touches = materialize(touches)
    sinks.write_partitions(touches, f"{partials}_dates", ["batch_key"])
    now = part.select(F.col("batch_key").alias("_b"), F.col("comment_date").alias("_d"))
    left = touches.join(now, (F.col("batch_key") == F.col("_b")) & F.col("comment_date").eqNullSafe(F.col("_d")), "left_anti")
    zero = left.select(*[F.col(f.name) if f.name in left.columns else F.lit(0 if f.name in report.sums else None).cast(f.dataType).alias(f.name)
                         for f in part.schema.fields])
    sinks.write_partitions(part.unionByName(zero), partials, ["comment_date", "batch_key"])
    stored = files.read_if_exists(spark, partials, part.schema)
    if stored is not None:
        summed = (files.same_partitions(stored, touches, "comment_date").groupBy(*report.keys)
                  .agg(*[F.sum(c).cast("long").alias(c) for c in report.sums]))
        sinks.write_gold(report.finish(summed), gold, "comment_date", only_present=True)


def silver_comments(spark: SparkSession, paths: Sequence[str], batch_col: str = "file_date") -> DataFrame | None:
    """The comments of some silver tables with their batch column as text; silver that holds posts is flattened. None where no table exists yet."""
    out = None
    for path in paths:
        silver = _silver(spark, path)
        if silver is None:
            continue
        if "comments" in silver.columns and "comment_message" not in silver.columns:
            silver = flatten.flatten_posts(silver, keep=(batch_col,))
        out = silver if out is None else out.unionByName(silver, allowMissingColumns=True)
    return out


def aggregate_ready(spark: SparkSession, readiness: DataFrame, silver_of: dict[int, list[str]],
                    gold_of: dict[tuple[int, str], str], aggregation_audit: str, batch_col: str = "file_date",
                    reports_: Mapping[str, Report] = REPORTS) -> DataFrame:
    """Refresh the gold of every ready (dataset, aggregation, batch) that isn't done yet (G1), and log it.

    ``readiness`` is that of ``planning.dependency_readiness``. Done means: the aggregation's own audit of that batch says ``Success``,
    written after the batch became ready; so one aggregation's failure leaves the others done, and a batch
    validated again is folded again. One job for each registered aggregation of a dataset (``gold_of``), however many batches are
    ready: the dependencies' silver (as ``validate_pending`` writes it: by the batch's stamp) is joined to the ready batches on
    its partition column, so Spark reads only those, and folded into the report that the aggregation's registered
    name decides, each batch by itself. A batch without a silver row is ``Skipped``, so that it doesn't block a later run, and
    what an earlier delivery of it added is taken back. Returns the audit events written.
    """
    from feedlens.operators import audit as audit_ops
    from feedlens.session import materialize, small

    keys = ["dataset_id", "aggregation_name", "batch_ts", "business_date"]
    wanted = readiness.filter("ready").select(*keys, "ready_seq")
    log = files.read_if_exists(spark, aggregation_audit, schemas.AGGREGATION_AUDIT)
    if log is not None:
        wanted = audit_ops.not_yet_done(wanted, audit_ops.current_status(log, audit_ops.AGGREGATION_KEYS), since="ready_seq")
    # stamped before silver is read, so a batch validated while this runs is asked for again
    clock = F.unix_micros(F.current_timestamp())
    ready = materialize(wanted.select(*keys, clock.alias("seq"), F.date_format("batch_ts", dates.STAMP_FORMAT).alias("batch_key")))
    events = None
    for (dataset, aggregation), gold in gold_of.items():
        mine = ready.filter((F.col("dataset_id") == dataset) & (F.col("aggregation_name") == aggregation))
        if mine.isEmpty():
            continue
        try:
            comments = silver_comments(spark, silver_of.get(dataset, []), batch_col)
            held = mine.select("batch_key").limit(0)
            if comments is not None:
                batches = small(mine.select(F.col("batch_key").alias(batch_col)).distinct())
                held = _batches_held(spark, silver_of[dataset], batches, batch_col)
                scored = sentiment.score(comments.join(batches, batch_col, "left_semi")
                                         .withColumn("batch_key", F.col(batch_col)), "comment_message")
                fold_partials(spark, reports.enrich(scored), reports_[aggregation], f"{gold}_partials", gold,
                              mine.select("batch_key"))
            there = held.select("batch_key", F.lit("Success").alias("_there"))
            mine = mine.join(there, "batch_key", "left").withColumns({
                "status": F.coalesce("_there", F.lit("Skipped")), "error_message": F.lit(None).cast("string")})
        except Exception as e:  # noqa: BLE001 - recorded, the next target still runs
            mine = mine.withColumns({"status": F.lit("Failed"), "error_message": F.lit(str(e)[:2000])})
        own = materialize(mine.select(*keys, "seq", "status", "error_message", F.current_user().alias("actor"),
                                      F.current_timestamp().alias("at")))
        sinks.write_events(own, aggregation_audit, f"aggregation-{dataset}-{aggregation}-{uuid.uuid4().hex}")
        events = own if events is None else events.unionByName(own)
    empty = spark.createDataFrame([], schemas.AGGREGATION_AUDIT)
    return empty if events is None else empty.unionByName(events)


def _batches_held(spark: SparkSession, paths: Sequence[str], batches: DataFrame, batch_col: str) -> DataFrame:
    """Those of the batches (``batch_key``) of which some silver table holds a row; only the partition column is read."""
    from feedlens.session import materialize

    out = None
    for path in paths:
        silver = _silver(spark, path)
        if silver is not None:
            held = silver.select(batch_col).join(batches, batch_col, "left_semi")
            out = held if out is None else out.unionByName(held)
    return materialize(out.distinct().withColumnRenamed(batch_col, "batch_key"))


def _silver(spark: SparkSession, path: str) -> DataFrame | None:
    """A silver table with its partition column as text, or None where it doesn't exist."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return table.withColumn("file_date", F.col("file_date").cast("string")) if "file_date" in table.columns else table


# ---- incremental error table ------------------------------------------------------------
def upsert_error_table(spark: SparkSession, source: DataFrame, path: str,
                       partition_col: str | list[str] = "file_date", msg_col: str = "error_message") -> None:
    """Upsert ``source`` error rows into the error table at ``path``, which is
    partitioned by ``partition_col`` (the batch; a list for several columns).

    Rows match on every column, the batch included, so rows from different
    batches can never match. Only the partitions that occur in ``source`` (NULL among them) are
    merged and rewritten, with dynamic partition overwrite: the cost follows the batch, not the
    table's history. The merged frame is cut from its lineage with a reliable checkpoint before
    it overwrites the path it was read from. The first errors create the table (K3).
    """
    from feedlens.session import materialize

    table = files.read_if_exists(spark, path, source.schema)
    target = None if table is None else files.same_partitions(table, source, partition_col)
    merged = materialize(upsert.upsert_errors(target, source, msg_col).select(*source.columns))
    sinks.write_partitions(merged, path, [partition_col] if isinstance(partition_col, str) else partition_col)


# ---- incremental gold (late comments) -----------------------------------------------------
def refresh_gold_incremental(spark: SparkSession, silver_batch: DataFrame, batch_key: str,
                             partials: str, gold: str, text_col: str = "comment_message") -> None:
    """Fold one silver batch into the daily NPS/CSAT gold table. Comments arrive up to days after their
    post, so one batch touches several comment dates; see ``fold_partials``."""
    scored = sentiment.score(silver_batch.withColumn("batch_key", F.lit(batch_key)), text_col)
    fold_partials(spark, reports.enrich(scored), REPORTS["daily_kpi"], partials, gold)


def start_gold_stream(spark: SparkSession, silver: str, silver_schema, partials: str, gold: str,
                      checkpoint: str, text_col: str = "comment_message",
                      available_now: bool = True, max_files_per_trigger: int | None = None):
    """Keep the daily gold table current as silver files arrive (R11 as a stream).

    Each micro-batch is folded in with ``refresh_gold_incremental`` under a key of the query's id, which
    its checkpoint keeps, and the batch's: a replayed batch replaces its own partials. A new checkpoint reads
    all silver again, so it needs new ``partials`` too.
    """
    reader = spark.readStream.schema(silver_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(silver)

    def fold(batch: DataFrame, batch_id: int) -> None:
        key = f"{stream_key(batch.sparkSession, checkpoint)}-{batch_id}"
        refresh_gold_incremental(spark, batch, key, partials, gold, text_col)

    w = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
