"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame
over the given tables (or data Spark derives from them)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens import schemas
from feedlens.functions import dates, kpi
from feedlens.functions import lexicon as lx
from feedlens.functions.dates import POST_FILE_PATTERN
from feedlens.functions.rules import Rule
from feedlens.functions.text import words
from feedlens.operators import audit, cost, flatten, induction, planning, quality, reports, row_rules, sentiment, upsert
from feedlens.plans import jobs
from feedlens.session import scratch_path
from feedlens.sinks import catalog, tables as sinks
from feedlens.sinks.audit_log import AuditLog
from feedlens.sources import control as ctl
from feedlens.sources import files, fixtures, messages
from feedlens.sources import tables as tb
from feedlens.streaming import drain as drain_stream
from feedlens.streaming.ingest import IngestPaths, read_bronze

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LETTERS = regex.compile(r"\p{L}+")


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def scored_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.score(tb.comment_feed(spark, sf_dir), "comment_message")


def enriched_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.enrich(scored_comments(spark, sf_dir))


@register("daily_nps_csat")
def q_daily_nps_csat(spark, sf_dir):
    return reports.daily_nps_csat(enriched_comments(spark, sf_dir))


@register("overall_csat")
def q_overall_csat(spark, sf_dir):
    return reports.overall_csat(scored_comments(spark, sf_dir))


@register("overall_nps")
def q_overall_nps(spark, sf_dir):
    return reports.overall_nps(scored_comments(spark, sf_dir))


@register("category_distribution")
def q_category_distribution(spark, sf_dir):
    return reports.category_distribution(scored_comments(spark, sf_dir))


@register("daily_sentiment_trend")
def q_daily_sentiment_trend(spark, sf_dir):
    return reports.daily_sentiment_trend(enriched_comments(spark, sf_dir))


@register("daily_net_sentiment")
def q_daily_net_sentiment(spark, sf_dir):
    return reports.daily_net_sentiment(enriched_comments(spark, sf_dir))


# ---- sentiment at scale -------------------------------------------------------


@register("document_sentiment")
def q_document_sentiment(spark, sf_dir):
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return (sentiment.score(docs, "text", words_col="words")
            .select("doc_id", "lang",
                    F.size("words").cast("long").alias("n_words"),
                    "sentiment_score",
                    kpi.sentiment_label().alias("sentiment_label")))


@register("sentiment_by_lang")
def q_sentiment_by_lang(spark, sf_dir):
    docs = sentiment.score(tb.table(spark, sf_dir, "documents").select("lang", "text"), "text")
    lab = kpi.sentiment_label()
    return (docs.groupBy("lang")
            .agg(F.count("*").alias("n_docs"),
                 F.count_if(lab == kpi.POSITIVE).alias("n_positive"),
                 F.count_if(lab == kpi.NEGATIVE).alias("n_negative"),
                 F.count_if(lab == kpi.NEUTRAL).alias("n_neutral"),
                 F.min("sentiment_score").alias("min_score"),
                 F.max("sentiment_score").alias("max_score")))


@register("conversation_sentiment")
def q_conversation_sentiment(spark, sf_dir, scorer=None):
    turns = tb.table(spark, sf_dir, "conversations").select("role", "text")
    scored = sentiment.score(turns, "text", scorer=scorer, words_col="words")
    if "words" not in scored.columns:  # a custom scorer does not tokenise
        scored = scored.withColumn("words", words("text"))
    return (scored.groupBy("role", kpi.sentiment_label().alias("sentiment_label"))
            .agg(F.count("*").alias("n_turns"),
                 F.sum(F.size("words")).cast("long").alias("total_words")))


def _labelled(spark, sf_dir, part: int) -> tuple[DataFrame, DataFrame]:
    """Texts of one half of the ids, and the labels: the even half teaches, the odd one is held out."""
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", "lang", "text").filter(F.pmod("doc_id", F.lit(2)) == part)
    return docs, tb.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))


@register("induced_lexicon")
def q_induced_lexicon(spark, sf_dir):
    """Polarities learnt from the labels of the even half of ``documents``."""
    return induction.induce_lexicon(*_labelled(spark, sf_dir, 0))


@register("induced_sentiment")
def q_induced_sentiment(spark, sf_dir):
    """The odd half scored by the learnt lexicon and by the seed list: how often each is positive exactly where the label is, by language."""
    lexicon = induction.with_modifiers(induction.induce_lexicon(*_labelled(spark, sf_dir, 0)))
    docs, labels = _labelled(spark, sf_dir, 1)
    held_out = sentiment.score(docs.join(labels, "doc_id"), "text", out="seed_score")
    scored = sentiment.score_with_lexicon_table(held_out, ["doc_id"], lexicon, "text", out="learnt_score")
    return induction.agreement(scored, {"n_agree_seed": "seed_score", "n_agree_learnt": "learnt_score"})


def seed_score_series(texts: pd.Series) -> pd.Series:
    """A scorer from outside, as a user would plug one in (N2): the seed list's score, in pandas."""
    polarity = {w: p for w, p, k in lx.seed_lexicon() if k == lx.POL}
    modifier = {w: k for w, _, k in lx.seed_lexicon() if k != lx.POL}

    def one(text: str | None) -> float | None:
        if text is None:
            return None
        found = LETTERS.findall(text.lower())
        values = []
        for before, word in zip([None, *found], found):
            if word in polarity:
                p, kind = polarity[word], modifier.get(before)
                half = int(p / 2)
                values.append(-half if kind == lx.NEG else max(-1000, min(1000, p + half)) if kind == lx.BOOST else p)
        return sum(values) / (1000.0 * len(values)) if values else 0.0

    return texts.map(one)


@register("conversation_sentiment_plugged")
def q_conversation_sentiment_plugged(spark, sf_dir):
    """``conversation_sentiment`` with a scorer from outside in place of the lexicon's expressions."""
    return q_conversation_sentiment(spark, sf_dir, sentiment.pandas_scorer(seed_score_series))


# ---- flatten and cost ----------------------------------------------------------
@register("flatten_posts")
def q_flatten_posts(spark, sf_dir):
    return flatten.flatten_posts(tb.nested_feed(spark, sf_dir))


@register("flatten_posts_outer")
def q_flatten_posts_outer(spark, sf_dir):
    return flatten.flatten_posts(tb.nested_feed(spark, sf_dir), outer=True)


@register("usage_cost")
def q_usage_cost(spark, sf_dir):
    return cost.usage_cost(tb.usage_feed(spark, sf_dir))


# ---- data quality --------------------------------------------------------------

# Rule bindings used on the orders-derived batch.
ORDER_RULES = [
    Rule(1, "o_orderstatus", "column_null_validation", "STRING"),
    Rule(2, "o_orderpriority", "column_null_validation", "STRING"),
    Rule(3, "cust_ref", "data_type_validation", "INT"),
]
# The two seeded bindings on the post feed.
POST_RULES = [
    Rule(1, "message", "column_null_validation", "STRING"),
    Rule(2, "comments.data.message", "column_null_validation", "STRING"),
]


@register("null_rule_errors")
def q_null_rule_errors(spark, sf_dir):
    return quality.error_rows(tb.rule_input(spark, sf_dir), [ORDER_RULES[1]])


@register("multi_rule_errors")
def q_multi_rule_errors(spark, sf_dir):
    return quality.error_rows(tb.rule_input(spark, sf_dir), ORDER_RULES)


@register("data_type_rule")
def q_data_type_rule(spark, sf_dir):
    return quality.error_rows(tb.rule_input(spark, sf_dir), [ORDER_RULES[2]])


@register("rule_outcomes")
def q_rule_outcomes(spark, sf_dir):
    return quality.rule_outcomes(tb.rule_input(spark, sf_dir), ORDER_RULES)


@register("array_null_rule")
def q_array_null_rule(spark, sf_dir):
    return quality.error_rows(tb.nested_feed(spark, sf_dir), POST_RULES).select("id", "error_message")


@register("promote_valid")
def q_promote_valid(spark, sf_dir):
    batch = tb.rule_input(spark, sf_dir)
    return quality.promote_valid(batch, quality.error_rows(batch, ORDER_RULES), key="o_orderkey")


@register("error_upsert")
def q_error_upsert(spark, sf_dir):
    batch = tb.rule_input(spark, sf_dir)
    target = quality.error_rows(batch, [ORDER_RULES[0]])
    replay = batch.filter(F.col("o_orderpriority") == "1-URGENT")
    source = quality.error_rows(batch, [ORDER_RULES[1]]).unionByName(
        quality.error_rows(replay, [ORDER_RULES[0]]))
    return upsert.upsert_errors(target, source)


def _with_attributes(rows: DataFrame, turned: bool) -> DataFrame:
    """Error rows whose status and priority stand in a map, and in a map within a struct; the order of entries says nothing."""
    pairs = [("status", "o_orderstatus"), ("priority", "o_orderpriority")]
    entries = F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("key"), F.col(c).alias("value")) for k, c in (reversed(pairs) if turned else pairs)]))
    return rows.select("o_orderkey", "o_custkey", entries.alias("attributes"),
                       F.struct(F.col("o_orderdate").alias("day"), entries.alias("inner")).alias("origin"), "error_message")


@register("error_upsert_maps")
def q_error_upsert_maps(spark, sf_dir):
    """The upsert of ``error_upsert`` on rows with MAP columns, source and target with entries in different order; then distinct
    over the result and itself."""
    batch = tb.rule_input(spark, sf_dir)
    target = _with_attributes(quality.error_rows(batch, [ORDER_RULES[0]]), False)
    replay = batch.filter(F.col("o_orderpriority") == "1-URGENT")
    source = _with_attributes(quality.error_rows(batch, [ORDER_RULES[1]]).unionByName(quality.error_rows(replay, [ORDER_RULES[0]])), True)
    merged = upsert.upsert_errors(target, source)
    rows = upsert.distinct_rows(merged.unionByName(merged.withColumn("attributes", F.map_from_entries(F.reverse(F.map_entries("attributes"))))))
    return rows.select("o_orderkey", "o_custkey", F.col("attributes")["status"].alias("status"),
                       F.col("origin")["inner"]["priority"].alias("priority"), F.size("attributes").cast("long").alias("n_attributes"),
                       F.col("origin")["day"].alias("day"), "error_message")


# ---- audit trail and planning ----------------------------------------------------


def _audit_status(spark, sf_dir):
    """Current status only (hash-aggregated): what the planning views need."""
    return audit.current_status(ctl.audit_from_orders(spark, sf_dir))


@register("audit_current")
def q_audit_current(spark, sf_dir):
    return audit.current(ctl.audit_from_orders(spark, sf_dir))


@register("audit_compacted")
def q_audit_compacted(spark, sf_dir):
    """The current state from a stored log that was compacted twice while it grew: the snapshot and the events since."""
    log = AuditLog(spark, f"{scratch_path(spark, 'audit_compacted')}/audit", schemas.DATASET_AUDIT)
    events = ctl.audit_from_orders(spark, sf_dir)
    for part in range(3):
        sinks.write_events(events.filter(F.pmod("seq", F.lit(3)) == part), log.path, f"writer-{part}")
        if part < 2:
            log.compact()
    return log.current()


@register("audit_lifecycle")
def q_audit_lifecycle(spark, sf_dir):
    return audit.lifecycle_summary(_audit_status(spark, sf_dir))


@register("datasets_to_validate")
def q_datasets_to_validate(spark, sf_dir):
    return planning.datasets_to_validate(ctl.registry_from_orders(spark, sf_dir),
                                         _audit_status(spark, sf_dir))


@register("pending_rules")
def q_pending_rules(spark, sf_dir):
    reg = ctl.registry_from_orders(spark, sf_dir)
    cols = ctl.columns_from_registry(reg)
    rule_audit = audit.current_status(ctl.rule_audit_from_orders(spark, sf_dir),
                                      keys=("dataset_column_validation_id", "batch_ts"))
    to_validate = planning.datasets_to_validate(reg, _audit_status(spark, sf_dir))
    return (planning.pending_rules(to_validate, ctl.bindings_from_columns(cols),
                                   cols.drop("validation_id", "ix"), ctl.validations(spark), rule_audit)
            .select("dataset_id", "batch_ts", "business_date", "dcv_id", "column_name", "column_datatype",
                    "validation_name", "audit_status"))


def _aggregation_plan(spark, sf_dir):
    reg = ctl.registry_from_orders(spark, sf_dir)
    return planning.aggregation_plan(reg, ctl.dataset_aggregation_from_registry(reg), ctl.aggregations(spark),
                                     ctl.dependencies_from_registry(reg), _audit_status(spark, sf_dir))


@register("aggregation_plan")
def q_aggregation_plan(spark, sf_dir):
    return _aggregation_plan(spark, sf_dir).select(
        "dataset_id", "batch_ts", "business_date", "aggregation_id", "aggregation_name", "gold_table",
        "dependant_dataset_id", "silver_table", "status", "dataset_status")


@register("dependency_readiness")
def q_dependency_readiness(spark, sf_dir):
    return planning.dependency_readiness(_aggregation_plan(spark, sf_dir))


@register("aggregation_guard")
def q_aggregation_guard(spark, sf_dir):
    """Ready batches of each aggregation that it has not folded, or not since they became ready: monthly batches, whose
    aggregations have succeeded, failed or not run."""
    reg = ctl.registry_from_orders(spark, sf_dir)
    state = audit.current_status(ctl.audit_from_orders(spark, sf_dir, monthly=True))
    plan = planning.aggregation_plan(reg, ctl.dataset_aggregation_from_registry(reg), ctl.aggregations(spark),
                                     ctl.dependencies_from_registry(reg), state)
    ready = (planning.dependency_readiness(plan).filter("ready")
             .select("dataset_id", "aggregation_id", "aggregation_name", "batch_ts", "business_date", "ready_seq"))
    runs = audit.current_status(ctl.aggregation_audit_from_orders(spark, sf_dir), audit.AGGREGATION_KEYS)
    return audit.not_yet_done(ready, runs, since="ready_seq")


# ---- sources: file names, quarantine, messages, rescue ---------------------------


K_SCHEMA = T.StructType([T.StructField("k", T.LongType())])


KV_SCHEMA = T.StructType(K_SCHEMA.fields + [
    T.StructField("v", T.ArrayType(T.StructType([T.StructField("u", T.LongType())])))])


@register("file_stamp_parse")
def q_file_stamp_parse(spark, sf_dir):
    names = tb.landing_rows(spark, sf_dir).select("source_file").distinct()
    return (files.with_file_columns(names)
            .select("source_file", "filename", "file_date", "year", "month", "day",
                    F.to_date("batch_ts").alias("business_date"),
                    F.hour("batch_ts").alias("batch_hour"), "name_ok"))


@register("quarantine_split")
def q_quarantine_split(spark, sf_dir):
    return files.file_report(files.with_file_columns(tb.landing_rows(spark, sf_dir)))


@register("message_decode")
def q_message_decode(spark, sf_dir):
    return messages.decode(tb.message_feed(spark, sf_dir), K_SCHEMA)


@register("message_encode")
def q_message_encode(spark, sf_dir):
    ev = tb.table(spark, sf_dir, "events").select(
        "event_id", "event_type", "user_id",
        F.round(F.col("value") * 100).cast("long").alias("value_cents"))
    enc = messages.encode(ev, "user_id", tb.TOPIC,
                          ["event_id", "event_type", "user_id", "value_cents"])
    return enc.select(F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"), "topic")


@register("rescue_unknown_keys")
def q_rescue_unknown_keys(spark, sf_dir):
    return (messages.rescue(tb.raw_json_feed(spark, sf_dir), "raw", KV_SCHEMA, "rescued")
            .select("event_id", "k", "rescued"))


@register("schema_drift")
def q_schema_drift(spark, sf_dir):
    """What of the raw JSON feed doesn't fit its schema, by day and key."""
    raw = tb.raw_json_feed(spark, sf_dir, F.to_date("ts").alias("day"))
    return messages.drift(messages.rescue(raw, "raw", KV_SCHEMA, "rescued"))


# ---- streams, sinks and jobs (write to the shared folder, read back) ----------------


def _paths(root: str) -> IngestPaths:
    return IngestPaths(landing=f"{root}/landing", bronze=f"{root}/bronze",
                       quarantine=f"{root}/quarantine", audit=f"{root}/audit",
                       checkpoint=f"{root}/checkpoint")


def _bronze_summary(spark, paths: IngestPaths, fmt: str = "json") -> DataFrame:
    return read_bronze(spark, paths.bronze, fmt).select(
        "id", "year", "month", "day",
        F.size(F.coalesce(F.col("comments.data"), F.array())).alias("n_comments"),
        F.col("_rescued").alias("rescued"))


def _ingested(spark, sf_dir, name: str, fmt: str = "json", layout: str = "lines") -> IngestPaths:
    """The derived landing files, ingested by the registry row of a dataset."""
    root = scratch_path(spark, name)
    {"lines": fixtures.write_landing, "json": fixtures.write_json_landing}[layout](spark, sf_dir, f"{root}/landing")
    row = {"id": 1, "name": "post_detail", "source_name": "feed", "source_path": f"{root}/landing", "bronze_path": f"{root}/bronze",
           "unknown_file_path": f"{root}/quarantine", "file_name": f"post_detail.{layout}", "file_name_format": POST_FILE_PATTERN, "format": fmt}
    registry = spark.createDataFrame([tuple(row.get(f.name) for f in schemas.DATASET.fields)], schemas.DATASET)
    return jobs.ingest_registered(spark, registry, "post_detail", "feed", f"{root}/audit", f"{root}/checkpoint")


@register("stream_to_bronze")
def q_stream_to_bronze(spark, sf_dir):
    return _bronze_summary(spark, _ingested(spark, sf_dir, "stream_to_bronze"))


@register("stream_to_csv_bronze")
def q_stream_to_csv_bronze(spark, sf_dir):
    return _bronze_summary(spark, _ingested(spark, sf_dir, "stream_to_csv_bronze", "csv"), "csv")


@register("stream_json_to_bronze")
def q_stream_json_to_bronze(spark, sf_dir):
    """Multi-line JSON landing files (arrays, and arrays of arrays), each read by as many tasks as its size asks for."""
    return _bronze_summary(spark, _ingested(spark, sf_dir, "stream_json_to_bronze", layout="json"))


@register("stream_json_quarantine")
def q_stream_json_quarantine(spark, sf_dir):
    """What the ingest of the multi-line files kept out of bronze: posts of wrongly named files, and elements that are no posts."""
    paths = _ingested(spark, sf_dir, "stream_json_quarantine", layout="json")
    return spark.read.schema("id string, _raw string, filename string").json(paths.quarantine).select(
        "id", F.col("_raw").alias("raw"), F.regexp_extract("filename", "^([^~]*)", 1).alias("landing_file"))


@register("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    """What the ingest kept out of bronze: posts of wrongly named files, and the texts of lines that are no post."""
    paths = _ingested(spark, sf_dir, "stream_quarantine")
    return spark.read.schema("id string, _raw string, filename string").json(paths.quarantine).select(
        "id", F.col("_raw").alias("raw"), F.regexp_extract("filename", "^([^~]*)", 1).alias("landing_file"))


@register("archive_consumed")
def q_archive_consumed(spark, sf_dir):
    """(K8) Landing files ingested in several micro-batches, each archived once a later batch has committed: every line is in the
    archive or still in the landing folder, none in both, and some have been archived."""
    root = scratch_path(spark, "archive_consumed")
    paths = _paths(root)
    paths.archive = f"{root}/archive"
    fixtures.write_landing(spark, sf_dir, paths.landing)
    jobs.ingest(spark, paths, 1, layout="lines", max_files_per_trigger=12)
    found = [spark.read.option("recursiveFileLookup", "true").text(path).select(
        dates.file_name(files.landing_path("_metadata.file_path")).alias("landing_file"), F.lit(archived).alias("archived"))
        for path, archived in ((paths.archive, 1), (paths.landing, 0))]
    lines = found[0].unionByName(found[1])
    some = lines.agg(F.max("archived").alias("some")).select(F.col("some") == 1).scalar()
    return lines.groupBy("landing_file").agg(F.count("*").alias("n_lines")).withColumn("some_archived", some)


@register("topic_drain")
def q_topic_drain(spark, sf_dir):
    """A feed drained twice: again from its start, under a new checkpoint, after messages have been added. The
    second drain lands the old messages and the new ones, and loses nothing of the first."""
    root = scratch_path(spark, "topic_drain")
    feed, paths = f"{root}/topic", _paths(root)
    messages_ = fixtures.message_rows(spark, sf_dir)
    for drained, part in (("first", F.col("offset") % 2 == 0), ("second", F.col("offset") % 2 == 1)):
        messages_.filter(part).write.mode("append").parquet(feed)
        drain_stream.start_drain(spark, feed, paths.landing, f"{root}/drained", f"{root}/checkpoint_{drained}",
                                 max_files_per_trigger=4).awaitTermination()
    jobs.ingest(spark, paths, dataset_id=1, layout="lines")
    # a drained file is stamped with the drain time, so its date parts are not data
    return _bronze_summary(spark, paths).drop("year", "month", "day")


@register("drain_counts")
def q_drain_counts(spark, sf_dir):
    """What a drain took from each source partition: messages landed, and messages without a value, of which nothing lands."""
    root = scratch_path(spark, "drain_counts")
    rows = fixtures.message_rows(spark, sf_dir)
    rows.withColumn("value", F.when(F.col("offset") % NULL_VALUE_EVERY != 0, F.col("value"))).write.parquet(f"{root}/topic")
    drain_stream.start_drain(spark, f"{root}/topic", f"{root}/landing", f"{root}/drained", f"{root}/checkpoint",
                             max_files_per_trigger=4).awaitTermination()
    return drain_stream.drained_counts(spark.read.parquet(f"{root}/drained"))


# Fixed value: offsets whose messages have no value.
NULL_VALUE_EVERY = 9


@register("batch_read_formats")
def q_batch_read_formats(spark, sf_dir):
    root = scratch_path(spark, "batch_read_formats")
    feed = tb.comment_feed(spark, sf_dir)
    day = F.substring("comment_created_time", 1, 10)
    staged = feed.withColumns({"year": F.substring(day, 1, 4), "month": F.substring(day, 6, 2),
                               "day": F.substring(day, 9, 2)})
    cols = ["comment_id", "comment_likes", "comment_message", "year", "month", "day"]
    for fmt in ("json", "csv"):
        sinks.write_partitions(staged.select(*cols), f"{root}/{fmt}", ["year", "month", "day"], fmt,
                               {"header": "true"} if fmt == "csv" else None)
    schema = T.StructType([T.StructField("comment_id", T.StringType()),
                           T.StructField("comment_likes", T.LongType()),
                           T.StructField("comment_message", T.StringType()),
                           T.StructField("year", T.StringType()),
                           T.StructField("month", T.StringType()),
                           T.StructField("day", T.StringType())])
    parts = [files.read_batch(spark, row["format"], row["bronze_path"], schema).withColumn("format", F.lit(row["format"]))
             for row in ({"format": fmt, "bronze_path": f"{root}/{fmt}"} for fmt in ("json", "csv"))]
    both = parts[0].unionByName(parts[1])
    return (both.groupBy("format", "year", "month", "day")
            .agg(F.count("*").alias("n_rows"), F.sum("comment_likes").alias("sum_likes")))


def _stamp() -> Column:
    """The stamp of a comment's batch: its day, and one of the day's three hours by its number."""
    hour = F.lpad((F.substring("comment_id", 2, 20).cast("long") % 3 * 8).cast("string"), 2, "0")
    return F.concat(F.substring("comment_created_time", 1, 10), F.lit("_"), hour, F.lit("-00-00"))


def _silver(spark, sf_dir, path: str) -> None:
    """Silver comments by batch stamp; the times of some can't be parsed."""
    bad = F.substring("comment_id", 2, 20).cast("long") % BAD_TIME_EVERY == 0
    flat = tb.comment_feed(spark, sf_dir, with_source=True).withColumn("file_date", _stamp())
    flat = flat.withColumn("comment_created_time", F.when(bad, F.lit("soon")).otherwise(F.col("comment_created_time")))
    sinks.write_partitions(flat, path, ["file_date"])


# Comments whose time can't be parsed; batch days that are ready, by day of the month.
BAD_TIME_EVERY = 40
READY_DAYS = (2, 3, 17)


@register("gold_refresh")
def q_gold_refresh(spark, sf_dir):
    root = scratch_path(spark, "gold_refresh")
    _silver(spark, sf_dir, f"{root}/silver")
    jobs.refresh_gold(spark, spark.read.parquet(f"{root}/silver"), f"{root}/gold")
    return jobs.read_gold(spark, f"{root}/gold")


@register("gold_stream")
def q_gold_stream(spark, sf_dir):
    """A file stream folds each micro-batch of silver files into gold through additive per-batch partials. The
    final gold must equal a full recomputation, unparsable times included."""
    root = scratch_path(spark, "gold_stream")
    _silver(spark, sf_dir, f"{root}/silver")
    schema = spark.read.parquet(f"{root}/silver").schema
    jobs.start_gold_stream(spark, f"{root}/silver", schema, f"{root}/partials", f"{root}/gold",
                           f"{root}/checkpoint", max_files_per_trigger=36).awaitTermination()
    return jobs.read_gold(spark, f"{root}/gold")


@register("aggregate_ready")
def q_aggregate_ready(spark, sf_dir):
    """Two aggregations of a dataset over the batches that are ready, three a day. One has folded the batches of one of those days
    already, the other has failed on them: the guard keeps them out of the first and lets the second run again."""
    root = scratch_path(spark, "aggregate_ready")
    _silver(spark, sf_dir, f"{root}/silver")
    stamp = _stamp().alias("stamp")
    batches = (tb.comment_feed(spark, sf_dir).select(stamp).distinct()
               .select(F.to_timestamp("stamp", dates.STAMP_FORMAT).alias("batch_ts"))
               .withColumns({"business_date": F.to_date("batch_ts"), "dataset_id": F.lit(5), "ready_seq": F.lit(1).cast("long"),
                             "ready": F.dayofmonth("batch_ts").isin(*READY_DAYS)}))
    names = ("daily_kpi", "sentiment_trend")
    readiness = batches.withColumn("aggregation_name", F.explode(F.array(*[F.lit(a) for a in names])))
    ran = readiness.filter(F.dayofmonth("batch_ts") == READY_DAYS[0])
    sinks.write_events(ran.select("dataset_id", "aggregation_name", "business_date", "batch_ts", F.lit(2).cast("long").alias("seq"),
                                  F.when(F.col("aggregation_name") == names[0], "Success").otherwise("Failed").alias("status")),
                       f"{root}/audit", "earlier")
    gold = {(5, a): f"{root}/gold_{a}" for a in names}
    jobs.aggregate_ready(spark, readiness, {5: [f"{root}/silver"]}, gold, f"{root}/audit")
    return _gold_by_day(spark, gold[5, "daily_kpi"], gold[5, "sentiment_trend"])


def _gold_by_day(spark, daily_path: str, trend_path: str) -> DataFrame:
    """The two gold tables side by side, by day (NULL: comments without a readable time)."""
    trend = jobs.read_trend(spark, trend_path).groupBy("comment_date").agg(
        F.sum("count").alias("n_labelled"),
        F.sum(F.when(F.col("sentiment_label") == kpi.POSITIVE, F.col("count")).otherwise(0)).alias("n_positive"))
    daily = jobs.read_gold(spark, daily_path).select("comment_date", "total_comments", "promoters")
    same = daily["comment_date"].eqNullSafe(trend["comment_date"])
    return daily.join(trend, same, "full").select(F.coalesce(daily["comment_date"], trend["comment_date"]).alias("comment_date"),
                                                  "total_comments", "promoters", "n_labelled", "n_positive")


# ---- all pending batches, and the whole way from landing files to gold ---------------------------


@register("row_rules")
def q_row_rules(spark, sf_dir):
    """Column and row validations in one pass over ``lineitem``: uniqueness of a key, presence in another table, a condition over columns."""
    items = tb.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")
    stocked = tb.table(spark, sf_dir, "part").filter("p_size > 5")
    return row_rules.error_rows(items, LINE_RULES, {"part": stocked})


@register("row_rule_outcomes")
def q_row_rule_outcomes(spark, sf_dir):
    items = tb.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")
    return row_rules.rule_outcomes(items, LINE_RULES, {"part": tb.table(spark, sf_dir, "part").filter("p_size > 5")})


# Rules over line items; an order's supplier should come once, parts should be stocked (size over 5).
LINE_RULES = [
    Rule(1, "l_orderkey", "row_unique_validation", None, '{"columns": ["l_orderkey", "l_suppkey"]}'),
    Rule(2, "l_partkey", "row_reference_validation", None, '{"columns": ["l_partkey"], "table": "part", "references": ["p_partkey"]}'),
    Rule(3, "l_quantity", "row_condition_validation", None, '{"condition": "l_quantity < 49 OR l_discount + l_tax < 0.1", "columns": ["l_quantity", "l_discount", "l_tax"]}'),
    Rule(4, "l_returns", "column_null_validation"),
]


@register("validate_all_pending")
def q_validate_all_pending(spark, sf_dir):
    """Every pending batch (a month's at one hour) of every dataset in one job, column and row rules, one dataset with a rule on a column it doesn't have:
    per batch its status, rule outcomes, error rows and silver rows."""
    root = scratch_path(spark, "validate_all_pending")
    rows = tb.rule_input(spark, sf_dir, *ctl.order_batch(monthly=True)).drop("business_date").withColumn(
        "file_date", F.date_format("batch_ts", dates.STAMP_FORMAT))
    reg = ctl.registry_from_orders(spark, sf_dir)
    cols = ctl.columns_from_registry(reg)
    bindings = ctl.bindings_from_columns(cols).unionByName(ctl.row_bindings(spark))
    ran = audit.current_status(ctl.rule_audit_from_orders(spark, sf_dir, monthly=True), keys=("dataset_column_validation_id", "batch_ts"))
    to_validate = planning.datasets_to_validate(reg, audit.current_status(ctl.audit_from_orders(spark, sf_dir, monthly=True)))
    pending = planning.pending_rules(to_validate, bindings, cols.drop("validation_id", "ix").unionByName(ctl.row_columns(spark)),
                                     ctl.validations(spark).unionByName(ctl.row_validations(spark)), ran)
    customers = tb.table(spark, sf_dir, "customer").filter("c_nationkey < 20")
    states = jobs.validate_pending(spark, rows, to_validate, pending, "o_orderkey", f"{root}/errors", f"{root}/silver",
                                   f"{root}/rule_audit", f"{root}/audit", {"customer": customers})
    batch = "dataset_id int, file_date string"
    outcomes = spark.read.schema(schemas.VALIDATION_AUDIT).parquet(f"{root}/rule_audit").groupBy(
        F.expr("cast(dataset_column_validation_id div 10 as int)").alias("dataset_id"), "batch_ts").agg(
        F.count("*").alias("n_rules"), F.count_if(F.col("status") == "Failed").alias("n_failed"),
        F.sum(F.regexp_extract("error_message", "^([0-9]+) error", 1).try_cast("long")).alias("n_rule_errors"))
    counts = [spark.read.schema(batch).parquet(f"{root}/{t}").groupBy("dataset_id", F.to_timestamp("file_date", dates.STAMP_FORMAT).alias("batch_ts"))
              .agg(F.count("*").alias(f"n_{t}")) for t in ("errors", "silver")]
    out = states.join(outcomes, ["dataset_id", "batch_ts"], "left")
    for n in counts:
        out = out.join(n, ["dataset_id", "batch_ts"], "left")
    return out.na.fill(0).select("dataset_id", "batch_ts", "business_date", "status", "error_message", "n_rules", "n_failed",
                                 "n_rule_errors", "n_errors", "n_silver")


class Medallion:
    """The whole way of one feed in a folder of its own: landing, bronze, silver and error table, two gold tables, three audits.

    Dataset 1 holds the feed's posts, validated by the two seeded rules; the aggregations of dataset 5 depend on it.
    """

    SOURCE, GOLD = 1, 5

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        row = {"source_name": "feed", "source_path": f"{root}/landing", "bronze_path": f"{root}/bronze", "unknown_file_path": f"{root}/quarantine",
               "file_name": "post_detail.lines", "file_name_format": POST_FILE_PATTERN, "format": "json"}
        rows = [row | {"id": self.SOURCE, "name": "post_detail", "layer": "silver"}, row | {"id": self.GOLD, "name": "feedback", "layer": "gold"}]
        self.registry = spark.createDataFrame([tuple(r.get(f.name) for f in schemas.DATASET.fields) for r in rows], schemas.DATASET)
        rules = POST_RULES
        self.columns = spark.createDataFrame([(r.id, self.SOURCE, r.column, r.datatype) for r in rules], schemas.DATASET_COLUMN)
        self.bindings = spark.createDataFrame([(r.id, r.id, 1, "yes", None) for r in rules], schemas.DATASET_COLUMN_VALIDATION)
        names = [name for _, name in ctl.AGGREGATIONS]
        self.wiring = (spark.createDataFrame([(i, self.GOLD, "yes") for i, _ in ctl.AGGREGATIONS], "aggregation_id int, dataset_id int, is_active string"),
                       ctl.aggregations(spark), spark.createDataFrame([(self.GOLD, self.SOURCE)], schemas.AGGREGATION_DEPENDENCY))
        self.gold = {(self.GOLD, name): f"{root}/gold_{name}" for name in names}

    def state(self) -> DataFrame:
        return audit.current_status(self.spark.read.schema(schemas.DATASET_AUDIT).parquet(f"{self.root}/audit"))

    def land_and_ingest(self, lines: DataFrame) -> None:
        sinks.write_landing(lines, f"{self.root}/landing")
        jobs.ingest_registered(self.spark, self.registry, "post_detail", "feed", f"{self.root}/audit", f"{self.root}/checkpoint")

    def validate(self) -> DataFrame:
        """Every batch whose current state is freshly ingested; bronze of files delivered again counts as last delivered."""
        ran = files.read_if_exists(self.spark, f"{self.root}/rule_audit", schemas.VALIDATION_AUDIT)
        ran = self.spark.createDataFrame([], schemas.VALIDATION_AUDIT) if ran is None else ran
        batches = planning.datasets_to_validate(self.registry, self.state(), "feed", with_seq=True)
        pending = planning.pending_rules(batches, self.bindings, self.columns, ctl.validations(self.spark),
                                         audit.current_status(ran, ("dataset_column_validation_id", "batch_ts")))
        rows = files.latest_delivery(read_bronze(self.spark, f"{self.root}/bronze")).withColumns(
            {"dataset_id": F.lit(self.SOURCE), "batch_ts": dates.batch_ts("file_date")})
        return jobs.validate_pending(self.spark, rows, batches, pending, "id", f"{self.root}/errors", f"{self.root}/silver",
                                     f"{self.root}/rule_audit", f"{self.root}/audit")

    def aggregate(self, reports_=jobs.REPORTS) -> DataFrame:
        readiness = planning.dependency_readiness(planning.aggregation_plan(self.registry, *self.wiring, self.state()))
        return jobs.aggregate_ready(self.spark, readiness, {self.GOLD: [f"{self.root}/silver/dataset_id={self.SOURCE}"]}, self.gold,
                                    f"{self.root}/aggregation_audit", reports_=reports_)


@register("batches_to_gold")
def q_batches_to_gold(spark, sf_dir):
    """Landing files of three batches a day to two gold tables: ingested, validated, flattened, scored, folded. The trend fails at first and
    is retried by itself. Then one batch of some days is delivered again with later comment times and fewer posts: it is ingested and
    validated again, and folded into gold in place of what it added before. Gold equals a computation over the last deliveries."""
    m = Medallion(spark, scratch_path(spark, "batches_to_gold"))
    m.land_and_ingest(fixtures.batch_posts(spark, sf_dir))
    m.validate()
    m.aggregate({"daily_kpi": jobs.REPORTS["daily_kpi"]})  # the trend's report isn't there yet
    m.aggregate()
    m.land_and_ingest(fixtures.batch_posts(spark, sf_dir, redelivered=True))
    m.validate()
    m.aggregate()
    return _gold_by_day(spark, *m.gold.values())


# ---- entry B with stored errors -----------------------------------------------------------


def _batches(spark, sf_dir) -> DataFrame:
    """Rule input by batch day (NULL for some rows); a status column whose rule rejects rows, and a priority column."""
    late = F.col("o_custkey") % 100 == 1
    return tb.rule_input(spark, sf_dir).withColumn(
        "file_date", F.when(late, F.lit(None).cast("string")).otherwise(F.date_format("o_orderdate", "yyyy-MM")))


@register("validate_retry")
def q_validate_retry(spark, sf_dir):
    """A batch validated twice: first with a rule that rejects rows and one whose column is missing, so that nothing is promoted;
    then with only the second rule pending. Silver must hold neither the rows of the first run's errors nor the second's."""
    root = scratch_path(spark, "validate_retry")
    batch = _batches(spark, sf_dir)
    first, second = ORDER_RULES[0], ORDER_RULES[1]
    jobs.validate(spark, batch.drop("o_orderpriority"), [first, second], "o_orderkey", f"{root}/errors_of_first", f"{root}/silver")
    jobs.validate(spark, batch, [first], "o_orderkey", f"{root}/errors", f"{root}/ignored")
    jobs.validate(spark, batch, [second], "o_orderkey", f"{root}/errors", f"{root}/silver")
    schema = T.StructType([f for f in batch.schema.fields])
    return spark.read.schema(schema).parquet(f"{root}/silver").select("o_orderkey", "o_custkey", "file_date")


@register("catalog_promotion")
def q_catalog_promotion(spark, sf_dir):
    """Two batches of error rows merged into a bucketed catalog table, and both batches' rows promoted against it into a bucketed
    silver table, the second batch twice: what the catalog then holds of each key's group."""
    run = scratch_path(spark, "t").rsplit("-", 1)[-1]
    errors, silver = f"feedlens_errors_{run}", f"feedlens_silver_{run}"
    rows = tb.rule_input(spark, sf_dir)
    for part, rules in ((0, ORDER_RULES[:1]), (1, ORDER_RULES[1:2]), (1, ORDER_RULES)):
        batch = rows.filter(F.coalesce(F.col("o_orderkey"), F.lit(0)) % 2 == part)
        catalog.upsert_errors(quality.error_rows(batch, rules), errors, "o_orderkey")
        valid = catalog.promote_valid(batch, errors, "o_orderkey")
        fresh = catalog.new_rows(valid, silver, "o_orderkey").filter("o_orderkey IS NOT NULL")
        catalog.append(fresh, silver, "o_orderkey")
    held = [catalog.stored(spark, t).select("o_orderkey", "o_custkey", m, F.lit(n).alias("held_in"))
            for t, n, m in ((errors, "errors", F.col("error_message")), (silver, "silver", F.lit(None).cast("string").alias("error_message")))]
    return held[0].unionByName(held[1])


@register("error_table_upsert")
def q_error_table_upsert(spark, sf_dir):
    """The stored error table after two upserts; batches without a date are kept."""
    root = scratch_path(spark, "error_table_upsert")
    batch = _batches(spark, sf_dir)
    for rule in ORDER_RULES[:2]:
        jobs.upsert_error_table(spark, quality.error_rows(batch, [rule]), f"{root}/errors")
    stored = quality.error_rows(batch, ORDER_RULES[:1]).schema
    return spark.read.schema(stored).parquet(f"{root}/errors").select("o_orderkey", "o_custkey", "file_date", "error_message")
