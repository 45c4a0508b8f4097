"""Validation and aggregation planning over the control tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def datasets_to_validate(registry: DataFrame, audit_current: DataFrame,
                         source_name: str = "facebook", layer: str = "silver",
                         statuses=("Success",), created_by: str | None = None, with_seq: bool = False) -> DataFrame:
    """(Q6) Ingested batches of a source/layer whose current status is in ``statuses``.

    The default picks freshly ingested batches; pass
    ``statuses=("Success", "Validation Failed")`` to retry batches whose
    validation did not complete. ``created_by`` keeps only batches whose
    current audit row was written by that actor (the audit view must then
    carry ``actor``). ``with_seq`` adds the audit's ``seq``, from which ``pending_rules`` sees that a batch
    has been delivered again since its rules ran.
    """
    reg = (registry.filter((F.col("source_name") == source_name) & (F.col("layer") == layer))
           .select(F.col("id").alias("dataset_id"), "name", "silver_table", "error_table_name"))
    aud = audit_current.filter(F.col("status").isin(list(statuses)))
    if created_by is not None:
        aud = aud.filter(F.col("actor") == created_by)
    seq = ["seq"] if with_seq else []
    aud = aud.select("dataset_id", "batch_ts", "business_date", *seq)
    return (reg.join(aud, "dataset_id")
            .select("dataset_id", "name", "batch_ts", "business_date", "silver_table", "error_table_name", *seq))


def pending_rules(to_validate: DataFrame, bindings: DataFrame, columns: DataFrame,
                  validations: DataFrame, rule_audit_current: DataFrame) -> DataFrame:
    """(Q5) Active rules of each batch with no audit row for it, or a Failed one.

    The rule audit is filtered to the batch inside the left join (the batch time is
    part of the join key), so rules without an audit row survive, and a later batch of the same
    day has all its rules pending again. Where both sides carry ``seq``, an audit row older than the batch's own
    counts for nothing: all rules of a batch that was delivered again are pending (``rerun``).
    """
    b = (bindings.filter(F.col("is_active") == "yes")
         .select(F.col("id").alias("dcv_id"), F.col("dataset_column_id").alias("_dc"),
                 F.col("validation_id").alias("_v"), "validation_parameters"))
    c = columns.select(F.col("id").alias("_dc"), "dataset_id", "column_name", "column_datatype")
    v = validations.select(F.col("id").alias("_v"), F.col("name").alias("validation_name"))
    rules = (b.join(c, "_dc").join(v, "_v")
             .select("dataset_id", "dcv_id", "column_name", "column_datatype",
                     "validation_name", "validation_parameters"))
    dated = "seq" in to_validate.columns and "seq" in rule_audit_current.columns
    va = rule_audit_current.select(F.col("dataset_column_validation_id").alias("dcv_id"),
                                   "batch_ts", F.col("status").alias("audit_status"),
                                   *([F.col("seq").alias("_ran")] if dated else []))
    stale = F.col("_ran") < F.col("_delivered") if dated else F.lit(False)
    return (to_validate.select("dataset_id", "batch_ts", "business_date", *([F.col("seq").alias("_delivered")] if dated else []))
            .join(rules, "dataset_id")
            .join(va, ["dcv_id", "batch_ts"], "left")
            .filter(F.col("audit_status").isNull() | (F.col("audit_status") == "Failed") | stale)
            .withColumn("rerun", F.coalesce(stale, F.lit(False))).drop("_ran", "_delivered"))


def aggregation_plan(registry: DataFrame, dataset_aggregation: DataFrame,
                     aggregations: DataFrame, dependencies: DataFrame,
                     audit_current: DataFrame) -> DataFrame:
    """(G2) For each active aggregation and each batch time at which any dependency
    has an audit row: one row per dependency with its silver table and its
    status if Validated (else NULL), plus the target dataset's own status."""
    aggs = aggregations.select(F.col("id").alias("aggregation_id"),
                               F.col("name").alias("aggregation_name"))
    active = (dataset_aggregation.filter(F.col("is_active") == "yes")
              .select("dataset_id", "aggregation_id").join(aggs, "aggregation_id"))
    target = registry.select(F.col("id").alias("dataset_id"), "gold_schema", "gold_table")
    deps = dependencies.select("dataset_id", "dependant_dataset_id")
    dep_audit = audit_current.select(F.col("dataset_id").alias("dependant_dataset_id"),
                                     "batch_ts", "business_date", F.col("status").alias("_dep_status"),
                                     F.col("seq").alias("dependency_seq"))
    dates = (active.select("dataset_id").join(deps, "dataset_id")
             .join(dep_audit, "dependant_dataset_id")
             .select("dataset_id", "batch_ts", "business_date").distinct())
    dep_info = registry.select(F.col("id").alias("dependant_dataset_id"), "silver_table",
                               "catalog", "silver_schema")
    own = audit_current.select("dataset_id", "batch_ts", F.col("status").alias("dataset_status"))
    return (dates.join(active, "dataset_id").join(target, "dataset_id")
            .join(deps, "dataset_id")
            .join(dep_info, "dependant_dataset_id")
            .join(dep_audit.drop("business_date"), ["dependant_dataset_id", "batch_ts"], "left")
            .join(own, ["dataset_id", "batch_ts"], "left")
            .withColumn("status", F.when(F.col("_dep_status") == "Validated", F.col("_dep_status")))
            .drop("_dep_status"))


def dependency_readiness(plan: DataFrame) -> DataFrame:
    """(G3) Per target dataset, aggregation and batch: ready when every dependency is Validated; ``ready_seq`` is the audit
    clock (``seq``) of the last dependency's state.

    The missing-dependency list is bounded by the dependencies registered for
    one dataset (a control-table fan-out), not by data volume.
    """
    missing = F.when(F.col("status").isNull(), F.col("dependant_dataset_id"))
    seq = F.col("dependency_seq") if "dependency_seq" in plan.columns else F.lit(None).cast("long")
    return (plan.groupBy("dataset_id", "aggregation_id", "aggregation_name", "batch_ts", "business_date")
            .agg(F.count("*").alias("n_dependencies"),
                 F.count("status").alias("n_validated"),
                 F.array_join(F.array_sort(F.collect_list(missing.cast("string"))), ",")
                  .alias("missing"),
                 F.max(seq).alias("ready_seq"))
            .withColumn("ready", F.col("n_validated") == F.col("n_dependencies")))
