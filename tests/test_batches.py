"""Row rules, all pending batches at once, deliveries that come again, and gold that takes back what they change."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedlens import schemas
from feedlens.functions.rules import Rule
from feedlens.operators import audit, planning, quality, row_rules, rulesets
from feedlens.plans import jobs
from feedlens.sinks import tables as sinks
from feedlens.sources import files

from .conftest import plan_text

UNIQUE = Rule(1, "a", "row_unique_validation", None, '{"columns": ["a", "b"]}')
REFERENCE = Rule(2, "c", "row_reference_validation", None, '{"columns": ["c"], "table": "known", "references": ["k"]}')
CONDITION = Rule(3, "n", "row_condition_validation", None, '{"condition": "n > 0 OR c IS NULL", "columns": ["n", "c"]}')


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- row rules -----------------------------------------------------------------------------
def test_row_rules_with_nulls_ties_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "x", "y", "p", 1), (2, "x", "y", "q", -1), (3, "x", None, "p", 1), (4, "x", None, None, -1), (5, "z", "y", "p", None),
                                (6, "w", "y", None, 1), (6, "w", "y", None, 1)], "id long, a string, b string, c string, n int")
    known = spark.createDataFrame([("p",), ("p",), (None,)], "k string")
    got = [(r["id"], r["error_message"]) for r in row_rules.error_rows(df, [CONDITION, REFERENCE, UNIQUE], {"known": known}).collect()]
    assert sorted(got) == [(1, "Key a, b is not unique"),
                           (2, "Key a, b is not unique | Key c is not in known | Row does not satisfy n > 0 OR c IS NULL"),
                           (6, "Key a, b is not unique"), (6, "Key a, b is not unique")]
    outcomes = {r["dcv_id"]: r["n_errors"] for r in row_rules.rule_outcomes(df, [CONDITION, REFERENCE, UNIQUE], {"known": known}).collect()}
    assert outcomes == {1: 4, 2: 1, 3: 1}
    assert row_rules.error_rows(df.limit(0), [UNIQUE, REFERENCE], {"known": known}).collect() == []


def test_row_rule_with_a_missing_column_or_table(spark):
    df = spark.createDataFrame([(1, "x")], "id long, a string")
    out = row_rules.rule_outcomes(df, [UNIQUE]).collect()
    assert [(r["status"], r["n_errors"]) for r in out] == [("Failed", None)]
    with pytest.raises(ValueError, match="unknown table"):
        row_rules.mark(df, [Rule(1, "a", "row_reference_validation", None, '{"table": "none"}')])
    with pytest.raises(ValueError, match="no condition"):
        quality.error_rows(df, [Rule(1, "a", "row_condition_validation")])


def test_unique_rule_on_a_hot_key(spark):
    """One key holds a third of the rows: it is counted in parts, and the mark's join doesn't move the rows by key."""
    n = 90_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"))
    rule = Rule(1, "a", "row_unique_validation")
    marked = row_rules.mark(df, [rule])
    assert marked.filter(F.col("__row_rule_1")).count() == n // 3 and marked.count() == n
    failing = row_rules.failing_keys(df, rule, {})
    assert failing.collect()[0]["_k0"] == "hot" and failing.count() == 1
    assert "partial_count" in plan_text(failing, "simple")


def test_row_rules_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice("uvw"), rng.choice(["s", "t", None]), rng.choice(["p", "q", "r", None]), rng.choice([1, 0, -1, None])) for k in range(300)]
    known = {"p", "r"}
    pairs = Counter((a, b) for _, a, b, _, _ in rows)
    want = {}
    for k, a, b, c, n in rows:
        messages = (["Key a, b is not unique"] if b is not None and pairs[a, b] > 1 else []) + \
            (["Key c is not in known"] if c is not None and c not in known else []) + \
            (["Row does not satisfy n > 0 OR c IS NULL"] if c is not None and n is not None and n <= 0 else [])
        if messages:
            want[k] = " | ".join(messages)
    df = spark.createDataFrame(rows, "id long, a string, b string, c string, n int")
    table = spark.createDataFrame([(k,) for k in known], "k string")
    assert {r["id"]: r["error_message"] for r in row_rules.error_rows(df, [UNIQUE, REFERENCE, CONDITION], {"known": table}).collect()} == want


# ---- all pending batches ------------------------------------------------------------------------
ROWS = "dataset_id int, batch_ts timestamp, file_date string, id string, a string, b string"
PENDING = ("dataset_id int, batch_ts timestamp, business_date date, dcv_id long, column_name string, column_datatype string, "
           "validation_name string, validation_parameters string, audit_status string, rerun boolean")


def at(day, hour):
    return dt.datetime(2024, 3, day, hour)


def stamp(day, hour):
    return f"2024-03-{day:02d}_{hour:02d}-00-00"


def batch_rows(dataset, day, hour, rows):
    return [(dataset, at(day, hour), stamp(day, hour), *r) for r in rows]


def pending_of(spark, rows, rerun=False):
    return spark.createDataFrame([(d, at(*b), dt.date(2024, 3, b[0]), dcv, col, "INT" if v.startswith("data") else "STRING", v, params, None, rerun)
                                  for d, b, dcv, col, v, params in rows], PENDING)


def batches_of(spark, batches):
    return spark.createDataFrame([(d, at(*b), dt.date(2024, 3, b[0])) for d, b in batches], "dataset_id int, batch_ts timestamp, business_date date")


def validated(spark, root, rows, batches, pending, **kw):
    states = jobs.validate_pending(spark, spark.createDataFrame(rows, ROWS), batches_of(spark, batches), pending, "id", f"{root}/errors",
                                   f"{root}/silver", f"{root}/rule_audit", f"{root}/audit", **kw)
    return {(r["dataset_id"], r["batch_ts"].day, r["batch_ts"].hour): (r["status"], r["error_message"]) for r in states.collect()}


def silver_ids(spark, root):
    df = files.read_if_exists(spark, f"{root}/silver", spark.createDataFrame([], ROWS).drop("batch_ts").schema)
    return sorted(((r["dataset_id"], r["file_date"], r["id"]) for r in df.collect()), key=repr) if df is not None else []


def test_all_pending_batches_equal_one_call_a_batch(spark, tmp_path):
    """Several datasets and batches with their own rules: errors, silver and outcomes as ``jobs.validate`` gives them batch by batch."""
    rng = random.Random(5)
    batches = [(1, (26, 0)), (1, (26, 8)), (2, (26, 0)), (3, (27, 0))]
    rules = {1: [(11, "a", "column_null_validation", None), (12, "b", "data_type_validation", None)], 2: [(21, "a", "row_unique_validation", None)], 3: []}
    rows = [r for d, b in batches for r in batch_rows(d, *b, [
        (rng.choice([f"i{k}", None]) if k % 9 == 0 else f"i{k}", rng.choice(["x", "y", None, f"u{k}"]), rng.choice(["1", "z", None])) for k in range(40)])]
    rows += batch_rows(9, 1, 0, [("other", None, None)])  # not pending: not looked at
    pending = pending_of(spark, [(d, b, *r) for d, b in batches for r in rules[d] if (d, b, r[0]) != (1, (26, 8), 12)])
    states = validated(spark, tmp_path, rows, batches, pending)
    assert set(states.values()) == {("Validated", None)}
    outcomes = {(r["dataset_column_validation_id"], r["batch_ts"].hour): r["error_message"]
                for r in spark.read.parquet(f"{tmp_path}/rule_audit").collect()}
    want_silver, want_errors, want_outcomes = [], [], {}
    for n, (d, b) in enumerate(batches):
        own = [Rule(k, c, v, "INT" if v.startswith("data") else "STRING", p) for k, c, v, p in rules[d] if (d, b, k) != (1, (26, 8), 12)]
        batch = spark.createDataFrame([r for r in rows if r[0] == d and r[1] == at(*b)], ROWS).drop("batch_ts")
        out = jobs.validate(spark, batch, own, "id", f"{tmp_path}/e{n}", f"{tmp_path}/s{n}")
        want_silver += [(r["dataset_id"], str(r["file_date"]), r["id"]) for r in spark.read.parquet(out["silver"]).collect()]
        if own:
            want_errors += [(d, r["id"], r["error_message"]) for r in spark.read.parquet(out["errors"]).collect()]
            want_outcomes |= {(r["dcv_id"], b[1]): f"{r['n_errors']} error rows" for r in out["outcomes"].collect()}
    assert sorted(silver_ids(spark, tmp_path), key=repr) == sorted(want_silver, key=repr)
    assert sorted([(r["dataset_id"], r["id"], r["error_message"]) for r in spark.read.parquet(f"{tmp_path}/errors").collect()], key=repr) == sorted(want_errors, key=repr)
    assert outcomes == want_outcomes
    audited = spark.read.schema(schemas.DATASET_AUDIT).parquet(f"{tmp_path}/audit")
    assert audited.count() == 4 and audited.filter("status = 'Validated'").count() == 4


def test_missing_column_and_batch_without_rows(spark, tmp_path):
    rows = batch_rows(1, 26, 0, [("i1", "x", "1")]) + batch_rows(2, 26, 0, [("i2", None, "1"), ("i3", "x", "1")])
    pending = pending_of(spark, [(1, (26, 0), 11, "zz", "column_null_validation", None), (2, (26, 0), 21, "a", "column_null_validation", None),
                                 (3, (26, 0), 31, "a", "column_null_validation", None)])
    states = validated(spark, tmp_path, rows, [(1, (26, 0)), (2, (26, 0)), (3, (26, 0))], pending)
    assert states == {(1, 26, 0): ("Validation Failed", "Column zz not found"), (2, 26, 0): ("Validated", None),
                      (3, 26, 0): ("Validation Failed", "Batch has no rows")}
    assert silver_ids(spark, tmp_path) == [(2, stamp(26, 0), "i3")]
    said = {r["dataset_column_validation_id"]: r["status"] for r in spark.read.parquet(f"{tmp_path}/rule_audit").collect()}
    assert said == {11: "Failed", 21: "Validation Passed"}


def test_retry_uses_stored_errors_and_a_redelivery_drops_them(spark, tmp_path):
    batch = [(1, (26, 0))]
    first = batch_rows(1, 26, 0, [("i1", None, "1"), ("i2", "x", "z"), ("i3", "x", "1")])
    rule_a, rule_b = (1, (26, 0), 11, "a", "column_null_validation", None), (1, (26, 0), 12, "b", "data_type_validation", None)
    validated(spark, tmp_path, first, batch, pending_of(spark, [rule_a]))
    validated(spark, tmp_path, first, batch, pending_of(spark, [rule_b]))  # only the second rule is pending now
    assert silver_ids(spark, tmp_path) == [(1, stamp(26, 0), "i3")]
    again = batch_rows(1, 26, 0, [("i1", "x", "1"), ("i4", None, "1")])
    validated(spark, tmp_path, again, batch, pending_of(spark, [rule_a, rule_b], rerun=True))
    assert silver_ids(spark, tmp_path) == [(1, stamp(26, 0), "i1")]
    assert [r["id"] for r in spark.read.parquet(f"{tmp_path}/errors").collect()] == ["i4"]
    # every row of a delivery rejected: nothing of the earlier ones stays
    validated(spark, tmp_path, batch_rows(1, 26, 0, [("i5", None, "z")]), batch, pending_of(spark, [rule_a, rule_b], rerun=True))
    assert silver_ids(spark, tmp_path) == []


def test_rows_of_a_hot_batch_stay_where_they_lie(spark, tmp_path):
    """A third of all rows in one batch: neither the rules nor a row rule's mark move rows by batch or key, unless batches are very many."""
    from feedlens.session import materialize
    rows = spark.range(30_000).select(
        F.lit(1).alias("dataset_id"), F.when(F.col("id") % 3 == 0, F.lit(at(26, 0))).otherwise(F.lit(at(26, 8))).alias("batch_ts"),
        F.lit("x").alias("file_date"), F.col("id").cast("string").alias("id"), F.when(F.col("id") % 7 == 0, "same").otherwise(F.col("id").cast("string")).alias("a"))
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    pending = pending_of(spark, [(1, (26, h), k, "a", v, None) for h in (0, 8) for k, v in ((11, "column_null_validation"), (12, "row_unique_validation"))])
    checks = rulesets.distinct_checks(pending)
    rules = rulesets.numbered(pending, checks)
    batches = materialize(rulesets.batches_with_rules(batches_of(spark, [(1, (26, 0)), (1, (26, 8))]), rules))
    failing = rulesets.failing_rows(rows, batches, checks)
    plan = plan_text(failing, "simple")
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2
    got = failing.groupBy("batch_ts").count().collect()
    assert {r["batch_ts"].hour: r["count"] for r in got} == {0: 30_000 // 21 + 1, 8: sum(1 for k in range(0, 30_000, 7) if k % 3)}


def test_no_batches(spark, tmp_path):
    assert validated(spark, tmp_path, [], [], pending_of(spark, [])) == {}
    assert rulesets.distinct_checks(pending_of(spark, [])) == []


def test_pending_rules_of_a_batch_delivered_again(spark):
    batches = spark.createDataFrame([(1, at(26, 0), dt.date(2024, 3, 26), 50)], "dataset_id int, batch_ts timestamp, business_date date, seq long")
    bindings = spark.createDataFrame([(k, k, 1, "yes", None) for k in (1, 2, 3)], schemas.DATASET_COLUMN_VALIDATION)
    columns = spark.createDataFrame([(k, 1, c, "STRING") for k, c in ((1, "a"), (2, "b"), (3, "c"))], schemas.DATASET_COLUMN)
    validations = spark.createDataFrame([(1, "column_null_validation", "column")], schemas.VALIDATION)
    ran = spark.createDataFrame([(1, at(26, 0), 40, "Validation Passed"), (2, at(26, 0), 60, "Validation Passed")],
                                "dataset_column_validation_id long, batch_ts timestamp, seq long, status string")
    got = planning.pending_rules(batches, bindings, columns, validations, ran).select("dcv_id", "rerun")
    assert rows_of(got) == [(1, True), (3, False)]


def test_latest_delivery(spark):
    u1, u2 = "0a1b2c3d-0000-0000-0000-00000000000a", "9a1b2c3d-0000-0000-0000-00000000000b"
    rows = [("x", f"f.json~part-00000-{u2}-c000.txt", "2024-03-26 10:00:00.000001"), ("y", f"f.json~part-00001-{u2}-c000.txt", "2024-03-26 10:00:00.000000"),
            ("z", f"f.json~part-00000-{u1}-c000.txt", "2024-03-26 11:00:00.000000"), ("w", f"f.json~part-00007-{u1}-c000.txt", "2024-03-26 10:59:00.000000"),
            ("p", "plain.json", "2024-03-26 10:00:00.000000"), ("q", f"g.json~part-00000-{u1}-c000.txt", None)]
    got = files.latest_delivery(spark.createDataFrame(rows, "id string, filename string, landed_at string"))
    assert sorted(r["id"] for r in got.collect()) == ["p", "q", "w", "z"] and got.columns == ["id", "filename", "landed_at"]


# ---- gold ------------------------------------------------------------------------------------------
COMMENTS = "id string, comment_message string, comment_created_time string, file_date string"


def comment(k, text, day, batch):
    return (f"c{k}", text, f"2024-03-{day:02d}T10:00:00.000000+0000" if day else "soon", stamp(*batch))


def readiness_of(spark, rows):
    return spark.createDataFrame([(d, a, at(*b), dt.date(2024, 3, b[0]), ready, seq) for d, a, b, ready, seq in rows],
                                 "dataset_id int, aggregation_name string, batch_ts timestamp, business_date date, ready boolean, ready_seq long")


def silver_of(spark, root, rows):
    sinks.write_partitions(spark.createDataFrame(rows, COMMENTS), f"{root}/silver", ["file_date"])


def daily(spark, root, name="kpi"):
    return {str(r["comment_date"]): r["total_comments"] for r in jobs.read_gold(spark, f"{root}/{name}").collect()}


def test_each_ready_batch_is_folded_once_and_by_its_time(spark, tmp_path):
    """A batch that isn't ready stays out although its day's other batch is ready; a target without silver is skipped and asked for again."""
    root = str(tmp_path)
    silver_of(spark, root, [comment(1, "love it", 26, (26, 0)), comment(2, "bad", 27, (26, 0)), comment(3, "bad", 26, (26, 8)), comment(4, "bad", None, (26, 0))])
    gold = {(5, "daily_kpi"): f"{root}/kpi", (5, "sentiment_trend"): f"{root}/trend", (15, "daily_kpi"): f"{root}/kpi15"}
    ready = readiness_of(spark, [(5, "daily_kpi", (26, 0), True, 1), (5, "daily_kpi", (26, 8), False, 1), (5, "daily_kpi", (25, 0), True, 1),
                                 (5, "sentiment_trend", (26, 0), True, 1), (15, "daily_kpi", (26, 0), True, 1)])
    runs = [jobs.aggregate_ready(spark, ready, {5: [f"{root}/silver"], 15: [f"{root}/none"]}, gold, f"{root}/audit") for _ in range(2)]
    said = [sorted((r["dataset_id"], r["aggregation_name"], r["batch_ts"].day, r["status"]) for r in run.collect()) for run in runs]
    skipped = [(5, "daily_kpi", 25, "Skipped"), (15, "daily_kpi", 26, "Skipped")]
    assert said == [sorted([*skipped, (5, "daily_kpi", 26, "Success"), (5, "sentiment_trend", 26, "Success")]), skipped]
    assert daily(spark, root) == {"2024-03-26": 1, "2024-03-27": 1, "None": 1}
    assert jobs.read_trend(spark, f"{root}/trend").count() == 3


def test_one_failed_aggregation_is_retried_by_itself(spark, tmp_path):
    root = str(tmp_path)
    silver_of(spark, root, [comment(1, "love it", 26, (26, 0))])
    gold = {(5, a): f"{root}/{a}" for a in ("daily_kpi", "sentiment_trend")}
    ready = readiness_of(spark, [(5, a, (26, 0), True, 1) for _, a in gold])
    only = {"daily_kpi": jobs.REPORTS["daily_kpi"]}
    first = jobs.aggregate_ready(spark, ready, {5: [f"{root}/silver"]}, gold, f"{root}/audit", reports_=only)
    assert {r["aggregation_name"]: r["status"] for r in first.collect()} == {"daily_kpi": "Success", "sentiment_trend": "Failed"}
    second = jobs.aggregate_ready(spark, ready, {5: [f"{root}/silver"]}, gold, f"{root}/audit")
    assert {r["aggregation_name"]: r["status"] for r in second.collect()} == {"sentiment_trend": "Success"}
    assert jobs.aggregate_ready(spark, ready, {5: [f"{root}/silver"]}, gold, f"{root}/audit").collect() == []


def test_a_batch_validated_again_replaces_its_part_of_gold(spark, tmp_path):
    root = str(tmp_path)
    gold = {(5, "daily_kpi"): f"{root}/kpi", (5, "sentiment_trend"): f"{root}/trend"}

    def fold(seq):
        ready = readiness_of(spark, [(5, a, b, True, seq) for _, a in gold for b in ((26, 0), (26, 8))])
        return jobs.aggregate_ready(spark, ready, {5: [f"{root}/silver"]}, gold, f"{root}/audit")

    silver_of(spark, root, [comment(1, "love it", 26, (26, 0)), comment(2, "bad", 27, (26, 0)), comment(3, "bad", 26, (26, 8))])
    fold(1)
    assert daily(spark, root) == {"2024-03-26": 2, "2024-03-27": 1}
    # the first batch again: its comments have moved to the 28th
    silver_of(spark, root, [comment(1, "love it", 28, (26, 0))])
    later = 2**62
    assert {r["status"] for r in fold(later).collect()} == {"Success"}
    assert daily(spark, root) == {"2024-03-26": 1, "2024-03-28": 1}
    assert sorted((str(r["comment_date"]), r["count"]) for r in jobs.read_trend(spark, f"{root}/trend").collect()) == [("2024-03-26", 1), ("2024-03-28", 1)]
    # and again, without any row: what it added is taken back
    sinks.drop_partitions(spark, f"{root}/silver", spark.createDataFrame([(stamp(26, 0),)], "file_date string"), ["file_date"])
    assert {r["batch_ts"].hour: r["status"] for r in fold(later + 1).collect()} == {0: "Skipped", 8: "Success"}
    assert daily(spark, root) == {"2024-03-26": 1}


def test_posts_in_silver_are_flattened(spark, tmp_path):
    post = spark.createDataFrame([("p1", "t", "m", {"summary": {"total_count": 1}}, {"data": [
        {"id": "c1", "created_time": "2024-03-26T10:00:00.000000+0000", "message": "love it", "like_count": 1}]}, stamp(26, 0)),
        ("p2", "t", "m", None, None, stamp(26, 0))],
        "id string, created_time string, message string, likes struct<summary:struct<total_count:long>>, "
        "comments struct<data:array<struct<id:string,created_time:string,message:string,like_count:long>>>, file_date string")
    sinks.write_partitions(post, f"{tmp_path}/silver", ["file_date"])
    got = jobs.silver_comments(spark, [f"{tmp_path}/none", f"{tmp_path}/silver"])
    assert [(r["comment_id"], r["file_date"]) for r in got.collect()] == [("c1", stamp(26, 0))]
    assert jobs.silver_comments(spark, [f"{tmp_path}/none"]) is None


def test_guard_by_aggregation_and_time(spark):
    state = spark.createDataFrame([(5, "k", at(26, 0), 7, "Success"), (5, "t", at(26, 0), 7, "Failed")],
                                  "dataset_id int, aggregation_name string, batch_ts timestamp, seq long, status string")
    asked = spark.createDataFrame([(5, "k", at(26, 0), 3), (5, "t", at(26, 0), 3), (5, "k", at(26, 8), 3)],
                                  "dataset_id int, aggregation_name string, batch_ts timestamp, ready_seq long")
    assert [(r["aggregation_name"], r["batch_ts"].hour) for r in audit.not_yet_done(asked, state, since="ready_seq").orderBy("aggregation_name").collect()] == [("k", 8), ("t", 0)]
    assert audit.not_yet_done(asked.withColumn("ready_seq", F.lit(9)), state, since="ready_seq").count() == 3
