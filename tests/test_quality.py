"""Rules in one pass, array-path nulls, promotion and error upsert."""

import os

from pyspark.sql import functions as F

from feedlens.functions.rules import Rule
from feedlens.operators import quality, upsert

from .conftest import plan_text

RULES = [Rule(2, "b", "column_null_validation"), Rule(1, "a", "column_null_validation"),
         Rule(3, "c", "data_type_validation", "INT")]
ROWS = [(1, "x", "y", "5"), (2, None, "y", "5"), (3, None, None, "z"), (None, "x", None, None), (5, "x", "y", None)]
SCHEMA = "id long, a string, b string, c string"


def test_error_messages_in_rule_order(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r["id"]: r["error_message"] for r in quality.error_rows(df, RULES).collect()}
    assert got == {2: "Column a is null",
                   3: "Column a is null | Column b is null | Column c is not INT",
                   None: "Column b is null"}


def test_rule_outcomes(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = {r["dcv_id"]: r for r in quality.rule_outcomes(df, RULES + [Rule(4, "id", "column_null_validation")]).collect()}
    assert (out[1]["n_errors"], out[2]["n_errors"], out[3]["n_errors"]) == (2, 2, 1)
    assert out[4]["n_errors"] == 1
    assert all(r["status"] == "Validation Passed" for r in out.values())


def test_array_path_null_rule(spark):
    df = spark.createDataFrame(
        [("p1", {"data": [{"message": "a"}, {"message": None}]}), ("p2", None),
         ("p3", {"data": []}), ("p4", {"data": [{"message": "b"}]})],
        "id string, comments struct<data: array<struct<message: string>>>")
    got = {r["id"]: r["error_message"] for r in
           quality.error_rows(df, [Rule(1, "comments.data.message", "column_null_validation")]).collect()}
    assert got == {"p1": "Column comments.data.message has null elements",
                   "p2": "Column comments.data.message is null"}


def test_promotion_keeps_null_keys(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    valid = quality.promote_valid(df, quality.error_rows(df, RULES), "id")
    assert sorted((r["id"] for r in valid.collect()), key=lambda x: (x is None, x)) == [1, 5, None]


def test_rules_scan_the_batch_once(spark, tmp_path):
    path = str(tmp_path / "batch")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(path)
    df = spark.read.parquet(path)
    plan = plan_text(quality.error_rows(df, RULES), "simple")
    assert plan.count("FileScan parquet") == 1


def test_upsert_merges_messages_as_a_set(spark):
    tgt = spark.createDataFrame([(1, None, "m1"), (2, "x", "m1 | m2")], "id long, a string, error_message string")
    src = spark.createDataFrame([(1, None, "m3"), (1, None, "m2"), (2, "x", "m2"), (3, "y", "m1"), (3, "y", "m1")],
                                "id long, a string, error_message string")
    out = {r["id"]: r["error_message"] for r in upsert.upsert_errors(tgt, src).collect()}
    assert out == {1: "m1 | m2 | m3", 2: "m1 | m2", 3: "m1"}


def test_upsert_is_idempotent(spark):
    tgt = spark.createDataFrame([(1, None, "m1")], "id long, a string, error_message string")
    src = spark.createDataFrame([(1, None, "m2"), (2, "b", "m1")], "id long, a string, error_message string")
    once = upsert.upsert_errors(tgt, src)
    twice = upsert.upsert_errors(once, src)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_upsert_takes_map_columns(spark):
    df = spark.createDataFrame([(1, {"a": 1}, "m")], "id long, m map<string,int>, error_message string")
    assert [tuple(r) for r in upsert.upsert_errors(None, df).collect()] == [(1, {"a": 1}, "m")]


def test_incremental_error_table(spark, tmp_path):
    from feedlens.plans import jobs
    path = str(tmp_path / "errors")
    schema = "id long, a string, file_date string, error_message string"
    d1 = spark.createDataFrame([(1, None, "2024-03-26", "m1"), (2, "x", "2024-03-26", "m1")], schema)
    d2 = spark.createDataFrame([(3, "y", "2024-03-27", "m2")], schema)
    jobs.upsert_error_table(spark, d1, path)
    jobs.upsert_error_table(spark, d2, path)
    day2 = [f for f in os.listdir(os.path.join(path, "file_date=2024-03-27")) if f.endswith(".parquet")]
    again = spark.createDataFrame([(1, None, "2024-03-26", "m2"), (1, None, "2024-03-26", "m1")], schema)
    jobs.upsert_error_table(spark, again, path)
    jobs.upsert_error_table(spark, again, path)  # replay: no change
    got = {(r["id"], r["file_date"]): r["error_message"] for r in spark.read.schema(schema).parquet(path).collect()}
    assert got == {(1, "2024-03-26"): "m1 | m2", (2, "2024-03-26"): "m1", (3, "2024-03-27"): "m2"}
    # the other date's files were not rewritten
    assert [f for f in os.listdir(os.path.join(path, "file_date=2024-03-27")) if f.endswith(".parquet")] == day2


def test_data_type_rule_parameters(spark):
    df = spark.createDataFrame([(1, "2024-03-26"), (2, "26/03/2024"), (3, None)], "id long, d string")
    rule = Rule(1, "d", "data_type_validation", "STRING", '{"type": "date"}')
    got = {r["id"]: r["error_message"] for r in quality.error_rows(df, [rule]).collect()}
    assert got == {2: "Column d is not DATE"}


def test_hot_key_in_promotion_is_split_by_aqe(spark):
    """A key holding a third of the batch: AQE splits its partition of the
    left anti join (thresholds scaled down to test size), results unchanged."""
    from tests.conftest import plan_text
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        batch = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("id"),
            F.when((F.col("id") % 1000 == 1) & (F.col("id") % 3 != 0), F.lit(None))
             .otherwise(F.lit("v")).alias("v"))
        errors = quality.error_rows(batch, [Rule(1, "v", "column_null_validation")])
        valid = quality.promote_valid(batch, errors, "id")
        rows = valid.collect()  # runs this very plan, so explain shows its final form
        assert len(rows) == n - 20  # 20 error rows off the hot key; all of key 7 stays
        plan = plan_text(valid, "simple")
        assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_rules(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert quality.error_rows(df, []).count() == 0
    assert quality.rule_outcomes(df, []).count() == 0


def test_rule_on_a_missing_column_fails_alone(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rules = RULES + [Rule(9, "no_such_column", "column_null_validation")]
    got = {r["id"]: r["error_message"] for r in quality.error_rows(df, rules).collect()}
    assert got[3] == "Column a is null | Column b is null | Column c is not INT"
    out = {r["dcv_id"]: r for r in quality.rule_outcomes(df, rules).collect()}
    assert out[9]["status"] == "Failed" and out[9]["result"] == "Column no_such_column not found"
    assert out[9]["n_errors"] is None and out[1]["status"] == "Validation Passed"
