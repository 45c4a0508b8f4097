"""Row validations over several rows (Q9): uniqueness of a key in a batch, presence of a key in another table.

Each such rule is first reduced to the keys that fail it: keys counted more than once (partial counts, so a key
holding a third of the rows is one row a task before the shuffle), or distinct keys without a partner in the other
table (anti join). The failing keys, few in most batches, are cut from their lineage, counted (few enough are broadcast, so that
the rows stay where they lie) and joined to the rows as a mark, which the rule reads like a column (``functions.rules``). So column rules and row rules share
one pass, one message and one outcome per rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions import rules as R
from feedlens.functions.rules import Rule
from feedlens.operators import quality
from feedlens.session import materialize, small


def failing_keys(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """The keys (columns ``_k0``, ``_k1``... after ``by``) that fail a rule; keys holding a NULL never do.

    ``by`` names the columns of a batch, when ``df`` holds several: uniqueness is then asked within each.
    """
    columns = R.rule_columns(rule)
    keys = [f"_k{i}" for i in range(len(columns))]
    # columns of a batch may be NULL (a batch without a date); keys may not
    found = (df.select(*by, *[F.col(c).alias(k) for c, k in zip(columns, keys)])
             .dropna(subset=keys).groupBy(*by, *keys).agg(F.count("*").alias("_n")))
    if rule.validation == "row_unique_validation":
        return found.filter(F.col("_n") > 1).drop("_n")
    name = R.param(rule, "table")
    if name not in tables:
        raise ValueError(f"rule {rule.id} refers to the unknown table {name!r}")
    there = R.param(rule, "references") or columns
    known = tables[name].select(*[F.col(c).alias(k) for c, k in zip(there, keys)])
    return found.drop("_n").join(known, keys, "left_anti")


def mark(df: DataFrame, rules: Sequence[Rule], tables: Mapping[str, DataFrame] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``df`` with one boolean column for every rule over other rows whose columns exist; rows are never added or lost."""
    for rule in rules:
        if rule.validation not in R.MARKED_VALIDATIONS or not R.runs_on(rule, df.schema):
            continue
        columns, name = R.rule_columns(rule), R.mark_name(rule)
        failing = materialize(failing_keys(df, rule, tables or {}, by).withColumnsRenamed({b: f"_b{i}" for i, b in enumerate(by)}))
        same = [F.col(b).eqNullSafe(F.col(f"_b{i}")) for i, b in enumerate(by)]
        same += [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(columns)]
        own = df.columns
        df = (df.join(small(failing.withColumn(name, F.lit(True))), same, "left")
              .select(*own, F.coalesce(name, F.lit(False)).alias(name)))
    return df


def unmark(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.drop(*[R.mark_name(r) for r in rules])


def error_rows(df: DataFrame, rules: list[Rule], tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rows failing at least one rule, column and row rules alike, with their accumulated message."""
    return unmark(quality.error_rows(mark(df, rules, tables), rules), rules)


def rule_outcomes(df: DataFrame, rules: list[Rule], tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per rule: error count and outcome."""
    return quality.rule_outcomes(mark(df, rules, tables), rules)
