"""Append-only audit with a current view, lifecycle and guard."""

import datetime as dt

from pyspark.sql import functions as F

from feedlens.operators import audit, planning

D = dt.date(2024, 3, 26)


def _events(spark):
    rows = [(1, D, None, 1, "Started", None, "u", None), (1, D, None, 3, "Success", None, "u", None),
            (1, D, None, 2, "In-Progress", None, "u", None), (2, D, None, 5, "Failed", "boom", "u", None),
            (3, D, None, 9, "Success", None, "u", None)]
    return audit.audit_events(spark, rows)


def test_current_is_latest_by_seq(spark):
    cur = {r["dataset_id"]: r for r in audit.current(_events(spark)).collect()}
    assert cur[1]["status"] == "Success" and cur[1]["n_events"] == 3 and cur[1]["seq"] == 3
    assert cur[2]["status"] == "Failed" and cur[2]["error_message"] == "boom"


def test_lifecycle_summary(spark):
    out = {(r["dataset_id"], r["status"]): r for r in
           audit.lifecycle_summary(audit.current(_events(spark))).collect()}
    assert out[(1, "Success")]["phase"] == "ingest" and out[(1, "Success")]["is_terminal"]


def test_guard_blocks_only_success(spark):
    req = spark.createDataFrame([(1, None), (2, None), (4, None)], "dataset_id int, batch_ts timestamp")
    left = sorted(r["dataset_id"] for r in audit.not_yet_done(req, audit.current(_events(spark)), ("dataset_id", "batch_ts")).collect())
    assert left == [2, 4]


def test_event_columns(spark):
    ev = spark.range(1).select(*audit.event(7, "2024-03-26", "Validated", seq=F.lit(11).cast("long")))
    r = ev.collect()[0]
    assert (r["dataset_id"], str(r["business_date"]), r["status"], r["seq"]) == (7, "2024-03-26", "Validated", 11)


def test_readiness(spark):
    ts = dt.datetime(2024, 3, 26, 8)
    rows = [(10, a, ts, D, d, s) for a in (1, 2) for d, s in ((11, "Validated"), (12, None))] + [(20, 1, ts, D, 21, "Validated")]
    plan = spark.createDataFrame(rows, "dataset_id int, aggregation_id int, batch_ts timestamp, business_date date, "
                                 "dependant_dataset_id int, status string").selectExpr("*", "'x' AS aggregation_name")
    out = {(r["dataset_id"], r["aggregation_id"]): r for r in planning.dependency_readiness(plan).collect()}
    for a in (1, 2):  # each aggregation counts its own dependencies
        assert not out[10, a]["ready"] and out[10, a]["missing"] == "12" and out[10, a]["n_dependencies"] == 2
    assert out[20, 1]["ready"] and out[20, 1]["missing"] == ""


def test_batches_of_one_day_are_kept_apart(spark):
    """The second batch of a day has its own state, and its rules are pending again."""
    from feedlens import schemas
    ts = [dt.datetime(2024, 3, 26, h) for h in (1, 2)]
    ev = audit.audit_events(spark, [(1, D, ts[0], 1, "Validated", None, "u", None), (1, D, ts[1], 2, "Success", None, "u", None)])
    cur = audit.current(ev)
    assert sorted((r["batch_ts"], r["status"]) for r in cur.collect()) == [(ts[0], "Validated"), (ts[1], "Success")]
    n = len(schemas.DATASET.fields)
    reg = spark.createDataFrame([tuple([1, "d1", "facebook", "silver"] + [None] * (n - 4))], schemas.DATASET)
    rule_audit = spark.createDataFrame([(7, ts[0], "Validation Passed")], "dataset_column_validation_id long, batch_ts timestamp, status string")
    pending = planning.pending_rules(
        planning.datasets_to_validate(reg, cur, statuses=("Success", "Validated")),
        spark.createDataFrame([(7, 7, 1, "yes", None)], schemas.DATASET_COLUMN_VALIDATION),
        spark.createDataFrame([(7, 1, "c", "STRING")], schemas.DATASET_COLUMN),
        spark.createDataFrame([(1, "column_null_validation", "column")], schemas.VALIDATION), rule_audit).collect()
    assert [(r["dcv_id"], r["batch_ts"]) for r in pending] == [(7, ts[1])]


def test_datasets_to_validate_owner_filter(spark):
    from feedlens import schemas
    n = len(schemas.DATASET.fields)
    reg = spark.createDataFrame([tuple([1, "d1", "facebook", "silver"] + [None] * (n - 4)),
                                 tuple([2, "d2", "facebook", "silver"] + [None] * (n - 4))], schemas.DATASET)
    ev = audit.audit_events(spark, [(1, D, None, 1, "Success", None, "alice", None),
                                    (2, D, None, 1, "Success", None, "bob", None)])
    cur = audit.current(ev, carry=("status", "error_message", "actor"))
    assert {r["dataset_id"] for r in planning.datasets_to_validate(reg, cur).collect()} == {1, 2}
    mine = planning.datasets_to_validate(reg, cur, created_by="alice").collect()
    assert [r["dataset_id"] for r in mine] == [1]


def test_read_control_table(spark, tmp_path):
    from feedlens.sources import control as ctl
    root = str(tmp_path)
    ctl.validations(spark).write.parquet(f"{root}/validation")
    got = ctl.read_control(spark, root, "validation")
    assert got.schema == ctl.CONTROL_SCHEMAS["validation"]
    assert sorted(r["name"] for r in got.collect()) == ["column_null_validation", "data_type_validation"]


def test_current_status_matches_current(spark):
    from feedlens.sources import control as ctl
    ev = ctl.audit_from_orders(spark, "/root/testdata/sf0.001")
    a = audit.current(ev).select("dataset_id", "batch_ts", "business_date", "status", "seq", "n_events")
    b = audit.current_status(ev)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_event_rejects_unknown_status(spark):
    import pytest
    with pytest.raises(ValueError):
        audit.event(1, "2024-03-26", "Done-ish")
