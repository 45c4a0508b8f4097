"""Control tables (registry, rule bindings, audits, aggregation wiring).

``read_control`` reads a stored control table with its fixed schema; the
``*_from_orders`` builders derive a control feed from the given ``orders``
table so that the planning operators are exercised on data that grows with
the input: dataset = ``o_custkey % 20``, business date = order date, seq =
order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import schemas
from feedlens.sources.tables import table

N_DATASETS = 20

CONTROL_SCHEMAS = {
    "dataset": schemas.DATASET,
    "dataset_audit": schemas.DATASET_AUDIT,
    "dataset_column": schemas.DATASET_COLUMN,
    "validation": schemas.VALIDATION,
    "dataset_column_validation": schemas.DATASET_COLUMN_VALIDATION,
    "validation_audit": schemas.VALIDATION_AUDIT,
    "aggregation": schemas.AGGREGATION,
    "dataset_aggregation": schemas.DATASET_AGGREGATION,
    "aggregation_dependency": schemas.AGGREGATION_DEPENDENCY,
}


def read_control(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A stored control table ``<root>/<name>`` read with its fixed schema."""
    return spark.read.format(fmt).schema(CONTROL_SCHEMAS[name]).load(f"{root.rstrip('/')}/{name}")


# Batches a day in the derived audit trails, hours apart.
BATCHES_A_DAY, HOURS_APART = 3, 8


def batch_ts(date: Column, key: Column) -> Column:
    """The batch of a row: its day, at one of the day's batch hours."""
    hour = F.lpad((key % BATCHES_A_DAY * HOURS_APART).cast("string"), 2, "0")
    return F.concat(F.date_format(date, "yyyy-MM-dd "), hour, F.lit(":00:00")).cast("timestamp")


# Audit status by (o_orderstatus, o_orderpriority).
def audit_status(status: Column, priority: Column) -> Column:
    return (F.when(status == "F", F.lit("Validated"))
            .when(status == "O", F.when(priority == "3-MEDIUM", F.lit("In-Progress"))
                  .otherwise(F.lit("Success")))
            .otherwise(F.when(priority == "1-URGENT", F.lit("Validation Failed"))
                       .otherwise(F.lit("Failed"))))


# Columns bound to rules on every derived dataset
# (column index, column name, declared type, validation id).
COLUMN_BINDINGS = [
    (1, "o_orderstatus", "STRING", 1),
    (2, "o_orderpriority", "STRING", 1),
    (3, "cust_ref", "INT", 2),
]
# Registered validations and aggregations.
VALIDATIONS = [(1, "column_null_validation", "column"), (2, "data_type_validation", "column")]
AGGREGATIONS = [(1, "daily_kpi"), (2, "sentiment_trend")]
DEPENDENCY_OFFSETS = [1, 2, 3]
INACTIVE_AGGREGATION_DATASET = 15
RULE_FAIL_PRICE = 300000.0


def order_batch(monthly: bool = False) -> tuple[Column, Column, Column]:
    """(dataset_id, business_date, batch_ts) of an order; ``monthly`` gathers a month's orders on its first day, so that batches of
    all datasets meet at the same times."""
    day = F.to_date(F.date_trunc("month", "o_orderdate")) if monthly else F.to_date("o_orderdate")
    return ((F.col("o_custkey") % N_DATASETS).cast("int").alias("dataset_id"), day.alias("business_date"),
            batch_ts(day, F.col("o_orderkey")).alias("batch_ts"))


def audit_from_orders(spark: SparkSession, sf_dir: str, monthly: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = audit_status(F.col("o_orderstatus"), F.col("o_orderpriority"))
    return o.select(
        *order_batch(monthly),
        F.col("o_orderkey").alias("seq"),
        status.alias("status"),
        F.when(status.contains("Failed"),
               F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" failed")))
         .alias("error_message"),
        F.lit("pipeline").alias("actor"),
        F.lit(None).cast("timestamp").alias("at"),
    )


def registry_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registry row per dataset id present in the audit feed."""
    ids = audit_from_orders(spark, sf_dir).select("dataset_id").distinct()
    i = F.col("dataset_id")
    ist = i.cast("string")
    gold = i % 5 == 0
    cols = {
        "id": i,
        "name": F.concat(F.lit("dataset_"), ist),
        "source_name": F.when(i % 3 == 2, F.lit("instagram")).otherwise(F.lit("facebook")),
        "layer": F.when(gold, F.lit("gold")).otherwise(F.lit("silver")),
        "source_path": F.concat(F.lit("landing/"), ist),
        "bronze_path": F.concat(F.lit("bronze/"), ist),
        "archive_path": F.concat(F.lit("archive/"), ist),
        "unknown_file_path": F.concat(F.lit("unknown/"), ist),
        "file_name": F.lit("post_detail"),
        "file_name_format": F.lit(r"post_detail_(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})\.json"),
        "format": F.lit("json"),
        "write_mode": F.lit("append"),
        "frequency": F.lit("hourly"),
        "error_table_name": F.concat(F.lit("errors_"), ist),
        "catalog": F.lit("main"),
        "silver_schema": F.lit("silver"),
        "silver_table": F.concat(F.lit("silver_"), ist),
        "gold_schema": F.when(gold, F.lit("gold")),
        "gold_table": F.when(gold, F.concat(F.lit("gold_"), ist)),
    }
    return ids.select(*[c.cast(f.dataType).alias(f.name) for f, c in
                        zip(schemas.DATASET.fields, [cols[f.name] for f in schemas.DATASET.fields])])


def columns_from_registry(registry: DataFrame) -> DataFrame:
    """dataset_column rows: every dataset binds COLUMN_BINDINGS (row-local explode)."""
    arr = F.array(*[F.struct(F.lit(ix).alias("ix"), F.lit(c).alias("column_name"),
                             F.lit(t).alias("column_datatype"), F.lit(v).alias("validation_id"))
                    for ix, c, t, v in COLUMN_BINDINGS])
    return (registry.select(F.col("id").alias("dataset_id"), F.inline(arr))
            .withColumn("id", (F.col("dataset_id") * 10 + F.col("ix")).cast("long")))


def bindings_from_columns(cols: DataFrame) -> DataFrame:
    """dataset_column_validation rows (one rule per column; some inactive)."""
    return cols.select(
        F.col("id").alias("id"),
        F.col("id").alias("dataset_column_id"),
        F.col("validation_id").cast("long").alias("validation_id"),
        F.when((F.col("dataset_id") + F.col("ix")) % 4 == 0, F.lit("no")).otherwise(F.lit("yes"))
         .alias("is_active"),
        F.lit(None).cast("string").alias("validation_parameters"))


def validations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VALIDATIONS, schemas.VALIDATION)


def aggregations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AGGREGATIONS, schemas.AGGREGATION)


def rule_audit_from_orders(spark: SparkSession, sf_dir: str, monthly: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    _, day, at = order_batch(monthly)
    return o.select(
        ((F.col("o_custkey") % N_DATASETS) * 10 + F.col("o_custkey") % 3 + 1).cast("long")
         .alias("dataset_column_validation_id"),
        day, at,
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_totalprice") > RULE_FAIL_PRICE, F.lit("Failed"))
         .otherwise(F.lit("Validation Passed")).alias("status"),
        F.lit(None).cast("string").alias("error_message"))


def dataset_aggregation_from_registry(registry: DataFrame) -> DataFrame:
    """Every gold dataset has two aggregations; those of one are inactive."""
    gold = registry.filter(F.col("layer") == "gold")
    both = F.array(*[F.lit(a).cast("int") for a, _ in AGGREGATIONS])
    return gold.select(
        F.explode(both).alias("aggregation_id"),
        F.col("id").alias("dataset_id"),
        F.when(F.col("id") == INACTIVE_AGGREGATION_DATASET, F.lit("no")).otherwise(F.lit("yes"))
         .alias("is_active"))


def dependencies_from_registry(registry: DataFrame) -> DataFrame:
    gold = registry.filter(F.col("layer") == "gold")
    offs = F.array(*[F.lit(k) for k in DEPENDENCY_OFFSETS])
    return gold.select(F.col("id").alias("dataset_id"), F.explode(offs).alias("off")).select(
        "dataset_id", ((F.col("dataset_id") + F.col("off")) % N_DATASETS).cast("int")
        .alias("dependant_dataset_id"))


# Orders whose aggregation run failed.
FAILED_RUN_PRIORITIES = ("1-URGENT", "2-HIGH")


def aggregation_audit_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the gold datasets' aggregations over the monthly batches."""
    _, day, at = order_batch(monthly=True)
    return table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % (N_DATASETS // 5) * 5).cast("int").alias("dataset_id"),
        F.element_at(F.array(*[F.lit(name) for _, name in AGGREGATIONS]), (F.col("o_orderkey") % 2 + 1).cast("int")).alias("aggregation_name"),
        day, at, F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderpriority").isin(*FAILED_RUN_PRIORITIES), "Failed").otherwise("Success").alias("status"))


# A row rule, or a rule on a column that batches don't have, on some datasets
# (dataset, bound column, validation, parameters).
ROW_BINDINGS = [
    (1, "o_custkey", "row_reference_validation", '{"columns": ["o_custkey"], "table": "customer", "references": ["c_custkey"]}'),
    (6, "o_custkey", "row_unique_validation", '{"columns": ["o_custkey", "o_orderpriority"]}'),
    (7, "o_region", "column_null_validation", None),
    (9, "o_totalprice", "row_condition_validation", '{"condition": "o_totalprice < 200000 OR o_orderstatus = \'F\'", "columns": ["o_totalprice", "o_orderstatus"]}'),
]
ROW_VALIDATION_IDS = {"column_null_validation": 1, "row_reference_validation": 3, "row_unique_validation": 4, "row_condition_validation": 5}


def row_columns(spark: SparkSession) -> DataFrame:
    """dataset_column rows of ROW_BINDINGS (the fourth column of a dataset)."""
    return spark.createDataFrame([(d * 10 + 4, d, c, "STRING") for d, c, _, _ in ROW_BINDINGS], schemas.DATASET_COLUMN)


def row_bindings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d * 10 + 4, d * 10 + 4, ROW_VALIDATION_IDS[v], "yes", params) for d, _, v, params in ROW_BINDINGS],
                                 schemas.DATASET_COLUMN_VALIDATION)


def row_validations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, name, "row") for name, i in ROW_VALIDATION_IDS.items() if i > 2], schemas.VALIDATION)
