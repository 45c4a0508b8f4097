"""One-pass data-quality rules, rule outcomes and silver promotion (Q3, Q4, Q7, Q8).

The reference runs one notebook per rule, each re-reading the batch. Here all
pending rules become one expression: a single scan yields every failing row
with its messages joined in rule order, and one global aggregate yields the
per-rule outcome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.rules import Rule, checks, missing_rules

# Message separator and the rule-run outcome texts.
SEP = " | "
PASSED = "Validation Passed"
PASSED_CLEAN = "Validation Passed with no errors"
FAILED = "Failed"
NOT_FOUND = "Column {column} not found"


def with_errors(df: DataFrame, rules: list[Rule], msg_col: str = "error_message") -> DataFrame:
    """Add ``msg_col``: failing-rule messages joined by `` | `` (``''`` if clean)."""
    cs = checks(rules, df.schema)
    msgs = [F.when(cond, F.lit(msg)) for _, cond, msg in cs]
    return df.withColumn(msg_col, F.concat_ws(SEP, *msgs) if msgs else F.lit(""))


def error_rows(df: DataFrame, rules: list[Rule], msg_col: str = "error_message") -> DataFrame:
    """Rows failing at least one rule, with their accumulated message."""
    cs = checks(rules, df.schema)
    if not cs:
        return with_errors(df, rules, msg_col).limit(0)
    any_fail = F.lit(False)
    for _, cond, _ in cs:
        any_fail = any_fail | F.coalesce(cond, F.lit(False))
    return with_errors(df.filter(any_fail), rules, msg_col)


def rule_outcomes(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: error count and outcome, from a single global aggregate.

    A rule that ran is ``Validation Passed`` whether or not rows failed (the
    notebook text distinguishes the two). A rule whose column is not in the
    batch did not run: it is ``Failed`` with a message, and stays pending.
    """
    out_schema = ("dcv_id long, column_name string, validation_name string, n_errors long, "
                  "result string, status string")
    missing = df.sparkSession.createDataFrame(
        [(r.id, r.column, r.validation, None, NOT_FOUND.format(column=r.column), FAILED)
         for r in missing_rules(rules, df.schema)], out_schema)
    cs = checks(rules, df.schema)
    per_rule: dict[int, list] = {}
    for r, cond, _ in cs:
        per_rule.setdefault(r.id, [r, []])[1].append(F.coalesce(cond, F.lit(False)))
    if not per_rule:
        return missing
    aggs = []
    for rid, (r, conds) in per_rule.items():
        any_c = conds[0]
        for c in conds[1:]:
            any_c = any_c | c
        aggs.append(F.count_if(any_c).alias(f"_n{rid}"))
    counts = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(rid).cast("long").alias("dcv_id"),
                              F.lit(r.column).alias("column_name"),
                              F.lit(r.validation).alias("validation_name"),
                              F.col(f"_n{rid}").alias("n_errors"))
                     for rid, (r, _) in per_rule.items()])
    ran = (counts.select(F.inline(rows))
           .withColumn("result", F.when(F.col("n_errors") > 0, PASSED).otherwise(PASSED_CLEAN))
           .withColumn("status", F.lit(PASSED)))
    return ran.unionByName(missing) if missing_rules(rules, df.schema) else ran


def promote_valid(batch: DataFrame, errors: DataFrame, key: str = "id") -> DataFrame:
    """Batch rows whose key has no error row (left anti join on the key).

    A NULL key never matches, so such rows are kept, as in the reference.
    The error keys are deliberately not de-duplicated: duplicates do not
    change an anti join, and with a plain shuffle on both sides AQE's
    skew-join rule can split a hot key of the batch (an aggregate between
    the shuffle and the join would hide the join from that rule). When the
    error keys are small, AQE broadcasts them instead.
    """
    bad = errors.select(key).filter(F.col(key).isNotNull())
    return batch.join(bad, key, "left_anti")
