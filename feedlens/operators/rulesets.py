"""Rules as data over every pending batch at once (Q3-Q8).

The reference loops over datasets and batches and runs one notebook a rule. Here the pending rules of all batches are a
table. The distinct checks among them (column, validation, type, parameters; bounded by the registry, not by
batches) become Column expressions; each batch carries the array of its pending rules, so one scan of all rows finds
every failing row of every batch with its messages in rule order, and outcomes are counted by (dataset, batch, rule).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions import rules as R
from feedlens.functions.rules import Rule
from feedlens.operators import quality, row_rules
from feedlens.session import small

BATCH = ("dataset_id", "batch_ts")
_CHECK = ("column_name", "validation_name", "column_datatype", "validation_parameters")


def distinct_checks(pending: DataFrame) -> list[Rule]:
    """The different checks among the pending rules, numbered; a control frame that the registry bounds."""
    rows = sorted(pending.select(*_CHECK).distinct().collect(), key=lambda r: tuple(v or "" for v in r))
    return [Rule(i, *row) for i, row in enumerate(rows)]


def numbered(pending: DataFrame, checks: list[Rule]) -> DataFrame:
    """The pending rules with the number of their check (``check_no``)."""
    spark = pending.sparkSession
    known = spark.createDataFrame([(c.column, c.validation, c.datatype, c.params, c.id) for c in checks],
                                  "_a string, _b string, _c string, _d string, check_no int")
    same = [pending[c].eqNullSafe(known[k]) for c, k in zip(_CHECK, ("_a", "_b", "_c", "_d"))]
    return pending.join(known, same).drop("_a", "_b", "_c", "_d")


def batches_with_rules(to_validate: DataFrame, rules: DataFrame) -> DataFrame:
    """Every batch to validate with its pending rules ``_rules``: an array of (dcv_id, check_no) in rule order, empty when none is pending."""
    per_batch = rules.groupBy(*BATCH).agg(F.array_sort(F.collect_list(F.struct("dcv_id", "check_no"))).alias("_rules"))
    empty = F.array().cast("array<struct<dcv_id:bigint,check_no:int>>")
    return (to_validate.select(*BATCH, "business_date").join(per_batch, list(BATCH), "left")
            .withColumn("_rules", F.coalesce("_rules", empty)))


def failing_rows(rows: DataFrame, batches: DataFrame, checks: list[Rule], tables: Mapping[str, DataFrame] | None = None,
                 msg_col: str = "error_message") -> DataFrame:
    """The rows of pending batches that fail a pending rule of theirs: ``failed_rules`` (ids) and the messages in rule order.

    ``rows`` hold ``dataset_id`` and ``batch_ts``. Rows of other batches are not looked at. ``batches`` is materialized; unless there are
    very many, every task gets them, and no row moves.
    """
    columns = rows.columns
    pending = rows.join(small(batches.select(*BATCH, "_rules")), list(BATCH)).select(*columns, "_rules")
    pending = row_rules.mark(pending, checks, tables, by=BATCH)
    found: list[Column] = [F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(check.id).alias("check_no"), F.lit(msg).alias("message")))
                           for check, cond, msg in R.checks(checks, pending.schema)]
    if not found:
        return (pending.limit(0).select(*columns, F.array().cast("array<bigint>").alias("failed_rules"), F.lit("").alias(msg_col)))
    failed = F.filter(F.array(*found), lambda x: x.isNotNull())
    marked = pending.withColumn("_failed", failed).filter(F.size("_failed") > 0)
    hits = F.flatten(F.transform("_rules", lambda rule: F.transform(
        F.filter("_failed", lambda f: f["check_no"] == rule["check_no"]),
        lambda f: F.struct(rule["dcv_id"].alias("dcv_id"), f["message"].alias("message")))))
    return (marked.withColumn("_hits", hits).filter(F.size("_hits") > 0)
            .select(*columns, F.array_distinct(F.transform("_hits", lambda h: h["dcv_id"])).alias("failed_rules"),
                    F.array_join(F.transform("_hits", lambda h: h["message"]), quality.SEP).alias(msg_col)))


def outcomes(rules: DataFrame, checks: list[Rule], failing: DataFrame, present: DataFrame, schema) -> DataFrame:
    """One row for every pending rule of every batch: error count, result and status (as ``quality.rule_outcomes``).

    ``present`` holds the batches that have rows: the rules of a batch without any did not run and get no outcome. A rule
    whose column isn't in ``schema`` is ``Failed``.
    """
    missing = {c.id: c for c in R.missing_rules(checks, schema)}
    counts = (failing.select(*BATCH, F.explode("failed_rules").alias("dcv_id")).groupBy(*BATCH, "dcv_id")
              .agg(F.count("*").alias("_n")))
    runs = ~F.col("check_no").isin(list(missing)) if missing else F.lit(True)
    n = F.when(runs, F.coalesce("_n", F.lit(0)))
    not_found = F.concat(F.lit("Column "), F.col("column_name"), F.lit(" not found"))
    return (rules.join(present.select(*BATCH).distinct(), list(BATCH), "left_semi").join(counts, [*BATCH, "dcv_id"], "left")
            .select(*BATCH, "business_date", "dcv_id", "column_name", "validation_name", n.alias("n_errors"),
                    F.when(~runs, not_found).when(n > 0, quality.PASSED).otherwise(quality.PASSED_CLEAN).alias("result"),
                    F.when(runs, quality.PASSED).otherwise(quality.FAILED).alias("status")))
