"""Explicit schemas of the data model (no inference anywhere)."""

from pyspark.sql import types as T

AUTHOR = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
])

COMMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("created_time", T.StringType()),
    T.StructField("from", AUTHOR),
    T.StructField("message", T.StringType()),
    T.StructField("like_count", T.LongType()),
])

POST = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("created_time", T.StringType()),
    T.StructField("from", AUTHOR),
    T.StructField("message", T.StringType()),
    T.StructField("likes", T.StructType([
        T.StructField("summary", T.StructType([T.StructField("total_count", T.LongType())])),
    ])),
    T.StructField("comments", T.StructType([T.StructField("data", T.ArrayType(COMMENT))])),
])

POST_FIELDS = [f.name for f in POST.fields]

# Columns added at ingest (all strings, as in the bronze layout).
BRONZE_EXTRA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("landed_at", T.StringType()),
    T.StructField("file_date", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("day", T.StringType()),
    T.StructField("filename", T.StringType()),
])

BRONZE = T.StructType(POST.fields + [T.StructField("_rescued", T.StringType())] + BRONZE_EXTRA.fields)

# One row per comment, post columns repeated.
FLAT_COMMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("created_time", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("total_count", T.LongType()),
    T.StructField("comment_id", T.StringType()),
    T.StructField("comment_created_time", T.StringType()),
    T.StructField("comment_message", T.StringType()),
    T.StructField("comment_likes", T.LongType()),
])

# Kafka-source record shape.
MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

DAILY_KPI = T.StructType([
    T.StructField("comment_date", T.DateType()),
    T.StructField("total_comments", T.LongType()),
    T.StructField("promoters", T.LongType()),
    T.StructField("detractors", T.LongType()),
    T.StructField("csat_positive", T.LongType()),
    T.StructField("NPS", T.DoubleType()),
    T.StructField("CSAT", T.DoubleType()),
])

USAGE = T.StructType([
    T.StructField("identity_metadata", T.StructType([T.StructField("owned_by", T.StringType())])),
    T.StructField("usage_date", T.DateType()),
    T.StructField("sku_name", T.StringType()),
    T.StructField("usage_quantity", T.DecimalType(12, 2)),
])

# Control tables (repaired forms; natural keys, no identity columns).
DATASET = T.StructType([T.StructField(n, T.IntegerType() if n == "id" else T.StringType()) for n in [
    "id", "name", "source_name", "layer", "source_path", "bronze_path", "archive_path",
    "unknown_file_path", "file_name", "file_name_format", "format", "write_mode", "frequency",
    "error_table_name", "catalog", "silver_schema", "silver_table", "gold_schema", "gold_table"]])

DATASET_AUDIT = T.StructType([
    T.StructField("dataset_id", T.IntegerType()),
    T.StructField("business_date", T.DateType()),
    T.StructField("batch_ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("actor", T.StringType()),
    T.StructField("at", T.TimestampType()),
])

# One event of an aggregation's run over a batch.
AGGREGATION_AUDIT = T.StructType([
    T.StructField("dataset_id", T.IntegerType()),
    T.StructField("aggregation_name", T.StringType()),
    T.StructField("business_date", T.DateType()),
    T.StructField("batch_ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("actor", T.StringType()),
    T.StructField("at", T.TimestampType()),
])

DATASET_COLUMN = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("dataset_id", T.IntegerType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("column_datatype", T.StringType()),
])

VALIDATION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("validation_type", T.StringType()),
])

DATASET_COLUMN_VALIDATION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("dataset_column_id", T.LongType()),
    T.StructField("validation_id", T.LongType()),
    T.StructField("is_active", T.StringType()),
    T.StructField("validation_parameters", T.StringType()),
])

VALIDATION_AUDIT = T.StructType([
    T.StructField("dataset_column_validation_id", T.LongType()),
    T.StructField("business_date", T.DateType()),
    T.StructField("batch_ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

AGGREGATION = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
])

DATASET_AGGREGATION = T.StructType([
    T.StructField("aggregation_id", T.IntegerType()),
    T.StructField("dataset_id", T.IntegerType()),
    T.StructField("is_active", T.StringType()),
])

AGGREGATION_DEPENDENCY = T.StructType([
    T.StructField("dataset_id", T.IntegerType()),
    T.StructField("dependant_dataset_id", T.IntegerType()),
])
