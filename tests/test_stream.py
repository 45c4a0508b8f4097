"""Landing -> bronze stream on hand-written files (S1, S4, K1, K5, M1-M6) and the drain."""

import json
import os

from pyspark.sql import functions as F

from feedlens.plans import jobs
from feedlens.streaming import drain
from feedlens.streaming.ingest import IngestPaths, read_bronze


def post(pid, comments, message="hello", extra=None):
    p = {"id": pid, "created_time": "2024-03-26T10:00:00.000000+0000",
         "from": {"id": "page", "name": "Brand"}, "message": message,
         "likes": {"summary": {"total_count": 5}},
         "comments": {"data": [{"id": f"{pid}-c{i}", "created_time": "2024-03-26T11:00:00.000000+0000",
                                "from": {"id": "u", "name": "U"}, "message": m, "like_count": 1}
                               for i, m in enumerate(comments)]}}
    if extra:
        p.update(extra)
    return p


def write(d, name, obj):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        json.dump(obj, f, indent=2)


def paths(root):
    return IngestPaths(landing=f"{root}/landing", bronze=f"{root}/bronze", quarantine=f"{root}/quarantine",
                       audit=f"{root}/audit", checkpoint=f"{root}/checkpoint")


def test_ingest_restart_and_replay(spark, tmp_path):
    root = str(tmp_path)
    p = paths(root)
    write(p.landing, "post_detail_2024-03-26_10-00-00.json",
          [post("a", ["good", None]), post("b", [], extra={"channel": "web"})])
    write(p.landing, "post_detail_2024-03-26_11-00-00.json", [[post("c", ["x"])], [post("d", ["y", "z"])]])
    write(p.landing, "post_detail_2024-03-26.json", [post("e", ["bad name"])])
    jobs.ingest(spark, p, dataset_id=1)

    bronze = read_bronze(spark, p.bronze)
    got = {r["id"]: r for r in bronze.collect()}
    assert sorted(got) == ["a", "b", "c", "d"]
    assert got["b"]["_rescued"] == '{"channel":"web"}' and got["a"]["_rescued"] is None
    assert got["a"]["year"] == "2024" and got["a"]["month"] == "03" and got["a"]["day"] == "26"
    assert got["c"]["filename"] == "post_detail_2024-03-26_11-00-00.json"
    assert [c["message"] for c in got["a"]["comments"]["data"]] == ["good", None]
    q = spark.read.json(p.quarantine)
    assert [r["id"] for r in q.collect()] == ["e"] and q.columns.count("ingest_batch") == 1
    aud = spark.read.parquet(p.audit)
    assert aud.filter("status = 'Success'").count() == 2
    assert [r["error_message"] for r in aud.filter("status = 'Failed'").collect()] == \
        ["Filename post_detail_2024-03-26.json format mismatch"]

    # restart from the checkpoint: only the new file is read
    write(p.landing, "post_detail_2024-03-27_09-00-00.json", [post("f", ["new"])])
    jobs.ingest(spark, p, dataset_id=1)
    assert read_bronze(spark, p.bronze).count() == 5
    assert spark.read.parquet(p.audit).filter("status = 'Success'").count() == 3

    # replay everything under a fresh checkpoint: partitions are rewritten, not duplicated
    p2 = IngestPaths(p.landing, p.bronze, p.quarantine, p.audit, f"{root}/checkpoint2")
    jobs.ingest(spark, p2, dataset_id=1)
    assert read_bronze(spark, p.bronze).count() == 5


def test_a_replayed_micro_batch_leaves_the_audit_as_it_was(spark, tmp_path):
    """M5: the same micro-batch handed over again rewrites its own events; another adds its own."""
    from feedlens.streaming.ingest import bronze_writer, parse_landing
    root = str(tmp_path)
    p = paths(root)
    os.makedirs(p.checkpoint)
    with open(f"{p.checkpoint}/metadata", "w") as f:
        f.write('{"id": "query-1"}')
    batch = parse_landing(spark.createDataFrame(
        [(json.dumps([post("a", [])]), f"{p.landing}/post_detail_2024-03-26_10-00-00.json"), ("[1]", f"{p.landing}/post_detail_x.json")],
        "value string, source_file string"))
    write_batch = bronze_writer(p, 1)
    counts = []
    for batch_id in (0, 0, 1):
        write_batch(batch, batch_id)
        counts.append(sorted((r["status"], r["count"]) for r in spark.read.parquet(p.audit).groupBy("status").count().collect()))
    once = [("Failed", 1), ("In-Progress", 1), ("Started", 1), ("Success", 1)]
    assert counts == [once, once, [(s, 2 * n) for s, n in once]]
    assert read_bronze(spark, p.bronze).count() == 1


MESSAGE = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"


def feed_of(spark, bodies, start=0):
    return spark.createDataFrame([(b"host", b if b is None else b.encode(), "topic", 0, start + i, None) for i, b in enumerate(bodies)], MESSAGE)


def landed(root):
    return sorted(f"{d.rsplit('/', 1)[1]}/{f}" for d, _, fs in os.walk(root) for f in fs if f.startswith("part-"))


def test_drain_then_ingest(spark, tmp_path):
    root = str(tmp_path)
    bodies = [json.dumps([post("m1", ["a"]), post("m2", [])], indent=1), json.dumps([[post("m3", ["b"])]]), json.dumps(post("m4", [])),
              None, "cut off {"]
    feed_of(spark, bodies).write.parquet(f"{root}/topic")
    p = paths(root)
    drain.start_drain(spark, f"{root}/topic", p.landing, f"{root}/drained", f"{root}/dcp").awaitTermination()
    assert all(n.startswith("landing_file=post_detail_") and ".json/part-" in n for n in landed(p.landing))
    log = spark.read.parquet(f"{root}/drained").collect()
    assert [(r["n_messages"], r["min_offset"], r["max_offset"]) for r in log] == [(4, 0, 4)]
    jobs.ingest(spark, p, dataset_id=1, layout="lines")
    assert sorted(r["id"] for r in read_bronze(spark, p.bronze).collect()) == ["m1", "m2", "m3", "m4"]
    assert [r["_raw"] for r in spark.read.schema("_raw string").json(p.quarantine).collect()] == ["cut off {"]


def test_a_second_drain_lands_old_and_new_messages(spark, tmp_path):
    root = str(tmp_path)
    p = paths(root)
    for k, body in enumerate([[post("a", [])], [post("b", [])]]):
        feed_of(spark, [json.dumps(body)], k).write.mode("append").parquet(f"{root}/topic")
        drain.start_drain(spark, f"{root}/topic", p.landing, f"{root}/drained", f"{root}/dcp{k}").awaitTermination()
        jobs.ingest(spark, p, dataset_id=1, layout="lines")
    assert sorted(r["id"] for r in read_bronze(spark, p.bronze).collect()) == ["a", "a", "b"]


def test_a_replayed_drain_batch_overwrites_its_folder(spark, tmp_path):
    root = str(tmp_path)
    p = paths(root)
    feed = feed_of(spark, [json.dumps([post(f"r{i}", [])]) for i in range(4)]).withColumn(
        drain.DRAINED_AT, F.lit("2024-05-01 10:00:00").cast("timestamp"))
    w = drain.drain_writer(p.landing, f"{root}/drained", lambda spark, batch_id: f"q-{batch_id}")
    for batch_id in (0, 0, 1):
        w(feed, batch_id)
    lines = spark.read.option("recursiveFileLookup", "true").text(p.landing)
    assert lines.count() == 8
    assert sorted(os.listdir(p.landing)) == ["_SUCCESS", "drain=q-0", "drain=q-1"] or {"drain=q-0", "drain=q-1"} <= set(os.listdir(p.landing))


def test_a_drain_batch_is_written_by_the_tasks_that_read_it(spark, tmp_path):
    """No shuffle and no cache: a part for each task that holds messages, none for deletions alone; nothing is lost."""
    root = str(tmp_path)
    p = paths(root)
    feed = feed_of(spark, [json.dumps(post(f"w{i}", []), indent=1) for i in range(9)] + [None]).repartition(3, "offset").withColumn(
        drain.DRAINED_AT, F.lit("2024-05-01 10:00:00").cast("timestamp"))
    n_tasks = feed.select(F.spark_partition_id()).distinct().count()
    w = drain.drain_writer(p.landing, f"{root}/drained", lambda spark, batch_id: f"q-{batch_id}")
    w(feed, 0)
    w(feed.filter("value is null"), 1)
    assert len(landed(p.landing)) == n_tasks > 1
    assert spark.read.option("recursiveFileLookup", "true").text(p.landing).count() == 9
    counts = spark.read.parquet(f"{root}/drained").agg(F.sum("n_messages"), F.sum("n_null")).first()
    assert tuple(counts) == (9, 2)
    assert os.listdir(f"{p.landing}/drain=q-0") == ["landing_file=post_detail_2024-05-01_10-00-00.json"] and not os.path.exists(f"{p.landing}/drain=q-1")


def test_a_drain_reads_its_query_id_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    feed_of(spark, [json.dumps(post(f"k{i}", [])) for i in range(3)]).repartition(3, "offset").write.parquet(f"{root}/topic")
    read = []
    monkeypatch.setattr(drain, "stream_key", lambda spark, checkpoint, own=drain.stream_key: read.append(checkpoint) or own(spark, checkpoint))
    drain.start_drain(spark, f"{root}/topic", f"{root}/landing", f"{root}/drained", f"{root}/dcp", max_files_per_trigger=1).awaitTermination()
    assert read == [f"{root}/dcp"] and len(os.listdir(f"{root}/landing")) > 1


def test_shapes_of_landing_files(spark, tmp_path):
    """One object, one object a line, elements that are no post, a truncated array; nothing readable or raw is lost."""
    root = str(tmp_path)
    p = paths(root)
    write(p.landing, "post_detail_2024-03-26_01-00-00.json", post("one", []))
    os.makedirs(p.landing, exist_ok=True)
    texts = {"02": json.dumps(post("l1", [])) + "\n" + json.dumps(post("l2", [])) + "\n", "03": json.dumps([post("ok", []), 1, "abc", None]),
             "04": '[{"id": "x", "message": "cut', "05": "", "06": json.dumps(post("last", []))[:-3]}
    for hour, text in texts.items():
        with open(os.path.join(p.landing, f"post_detail_2024-03-26_{hour}-00-00.json"), "w") as f:
            f.write(text)
    jobs.ingest(spark, p, dataset_id=1)
    assert sorted(r["id"] for r in read_bronze(spark, p.bronze).collect()) == ["l1", "l2", "ok", "one"]
    raw = [r["_raw"] for r in spark.read.schema("_raw string").json(p.quarantine).collect()]
    assert sorted(x for x in raw if x) == sorted(["1", "abc", texts["04"], texts["06"]])
    said = {r["filename"][23:25]: (r["status"], r["error_message"]) for r in spark.read.parquet(p.audit).filter("status in ('Success', 'Failed')").collect()}
    assert said["03"][0] == "Success" and "3 elements are no posts" in said["03"][1] and said["04"][0] == "Failed"
    assert all(r["batch_ts"] is not None for r in spark.read.parquet(p.audit).filter("status = 'Success'").collect())


def test_registered_pattern_and_format_reach_the_stream(spark, tmp_path):
    from feedlens import schemas
    root = str(tmp_path)
    write(f"{root}/in", "notes_2024-03-26_10-00-00.json", [post("n1", ["x"])])
    write(f"{root}/in", "post_detail_2024-03-26_10-00-00.json", [post("other", [])])
    row = {"id": 4, "name": "notes", "source_name": "s", "source_path": f"{root}/in", "bronze_path": f"{root}/b", "unknown_file_path": f"{root}/q",
           "file_name": "notes", "file_name_format": r"notes_(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})\.json", "format": "csv"}
    reg = spark.createDataFrame([tuple(row.get(f.name) for f in schemas.DATASET.fields)], schemas.DATASET)
    jobs.ingest_registered(spark, reg, "notes", "s", f"{root}/audit", f"{root}/cp")
    got = read_bronze(spark, f"{root}/b", "csv").collect()
    assert [(r["id"], r["day"], r["comments"]["data"][0]["message"]) for r in got] == [("n1", "26", "x")]
    assert spark.read.parquet(f"{root}/audit").filter("status = 'Failed'").count() == 1


def test_rejected_rows_stay_out_when_the_other_rules_run_later(spark, tmp_path):
    root = str(tmp_path)
    rows = [("c1", "2024-03-26", None, "x"), ("c2", "2024-03-26", "ok", None), ("c3", "2024-03-26", "ok", "y"), ("c4", None, None, "z"), ("c5", None, "ok", "z")]
    batch = spark.createDataFrame(rows, "id string, file_date string, a string, b string")
    cols = "dcv_id long, column_name string, validation_name string, column_datatype string, validation_parameters string"
    rule = lambda k, c: spark.createDataFrame([(k, c, "column_null_validation", "STRING", None)], cols)
    args = ("id", f"{root}/errors", f"{root}/silver", f"{root}/rule_audit", f"{root}/audit", 1, "2024-03-26 05:00:00")
    both = rule(11, "a").unionByName(rule(12, "b"))
    assert jobs.validate_and_audit(spark, batch.drop("b"), both, *args) == "Validation Failed"
    assert jobs.validate_and_audit(spark, batch, rule(12, "b"), *args) == "Validated"
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/silver").collect()) == ["c3", "c5"]
    assert {str(r["batch_ts"]) for r in spark.read.parquet(f"{root}/rule_audit").collect()} == {"2024-03-26 05:00:00"}


def test_validate_job_and_gold(spark, tmp_path):
    from feedlens.functions.rules import Rule
    root = str(tmp_path)
    batch = spark.createDataFrame(
        [("c1", "2024-03-26", "love it", "2024-03-26T10:00:00.000000+0000"),
         ("c2", "2024-03-26", None, "2024-03-26T11:00:00.000000+0000"),
         ("c3", "2024-03-26", "bad", "2024-03-27T01:00:00.000000+0000")],
        "id string, file_date string, comment_message string, comment_created_time string")
    rules = [Rule(1, "comment_message", "column_null_validation")]
    out = jobs.validate(spark, batch, rules, "id", f"{root}/errors", f"{root}/silver")
    assert spark.read.parquet(out["errors"]).count() == 1
    again = jobs.validate(spark, batch, rules, "id", f"{root}/errors", f"{root}/silver")
    errs = spark.read.parquet(again["errors"]).collect()
    assert len(errs) == 1 and errs[0]["error_message"] == "Column comment_message is null"
    silver = spark.read.parquet(f"{root}/silver")
    assert sorted(r["id"] for r in silver.collect()) == ["c1", "c3"]
    jobs.refresh_gold(spark, silver, f"{root}/gold")
    gold = {str(r["comment_date"]): r for r in jobs.read_gold(spark, f"{root}/gold").collect()}
    assert gold["2024-03-26"]["promoters"] == 1 and gold["2024-03-27"]["detractors"] == 1
    assert {r["dcv_id"]: r["n_errors"] for r in out["outcomes"].collect()} == {1: 1}


def test_archive_of_consumed_files(spark, tmp_path):
    """K8: with an archive folder, a landing file is moved once a later batch commits."""
    from feedlens.streaming.ingest import start_ingest
    root = str(tmp_path)
    p = paths(root)
    p.archive = f"{root}/archive"
    write(p.landing, "post_detail_2024-03-26_10-00-00.json", [post("a", ["x"])])
    write(p.landing, "post_detail_2024-03-26_11-00-00.json", [post("b", ["y"])])
    q = start_ingest(spark, p, dataset_id=1, max_files_per_trigger=1)
    q.awaitTermination()
    assert read_bronze(spark, p.bronze).count() == 2
    archived = [f for _, _, fs in os.walk(p.archive) for f in fs if f.endswith(".json")]
    left = [f for f in os.listdir(p.landing) if f.endswith(".json")]
    # the first batch's file is archived when the second batch commits; the last stays
    assert len(archived) == 1 and len(left) == 1 and set(archived) != set(left)


def test_validate_and_audit_entry_b(spark, tmp_path):
    root = str(tmp_path)
    batch = spark.createDataFrame(
        [("c1", "2024-03-26", "ok", "5"), ("c2", "2024-03-26", None, "x"), ("c3", "2024-03-26", "fine", "7")],
        "id string, file_date string, comment_message string, ref string")
    pending = spark.createDataFrame(
        [(11, "comment_message", "column_null_validation", "STRING", None),
         (12, "ref", "data_type_validation", "INT", None)],
        "dcv_id long, column_name string, validation_name string, column_datatype string, "
        "validation_parameters string")
    status = jobs.validate_and_audit(spark, batch, pending, "id", f"{root}/errors", f"{root}/silver",
                                     f"{root}/rule_audit", f"{root}/audit", 1, "2024-03-26 00:00:00")
    assert status == "Validated"
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/silver").collect()) == ["c1", "c3"]
    ra = {r["dataset_column_validation_id"]: r["error_message"] for r in spark.read.parquet(f"{root}/rule_audit").collect()}
    assert ra == {11: "1 error rows", 12: "1 error rows"}
    err = spark.read.parquet(f"{root}/errors").collect()
    assert [r["error_message"] for r in err] == ["Column comment_message is null | Column ref is not INT"]
    assert spark.read.parquet(f"{root}/audit").collect()[0]["status"] == "Validated"


def test_bronze_read_prunes_partitions(spark, tmp_path):
    from tests.conftest import plan_text
    root = str(tmp_path)
    p = paths(root)
    write(p.landing, "post_detail_2024-03-26_10-00-00.json", [post("a", ["x"])])
    write(p.landing, "post_detail_2024-04-01_10-00-00.json", [post("b", ["y"])])
    jobs.ingest(spark, p, dataset_id=1)
    df = read_bronze(spark, p.bronze).filter((F.col("year") == "2024") & (F.col("month") == "03"))
    plan = plan_text(df, "simple")
    assert "PartitionFilters: [isnotnull(year" in plan and "(month#" in plan
    assert [r["id"] for r in df.collect()] == ["a"]


def test_audit_lifecycle_of_one_file(spark, tmp_path):
    from feedlens.operators import audit
    root = str(tmp_path)
    p = paths(root)
    write(p.landing, "post_detail_2024-03-26_10-00-00.json", [post("a", ["x"])])
    jobs.ingest(spark, p, dataset_id=3)
    ev = spark.read.parquet(p.audit).filter("filename = 'post_detail_2024-03-26_10-00-00.json'")
    assert [r["status"] for r in ev.orderBy("seq").collect()] == ["Started", "In-Progress", "Success"]
    cur = audit.current(ev.drop("filename")).collect()[0]
    assert (cur["dataset_id"], str(cur["business_date"]), cur["status"]) == (3, "2024-03-26", "Success")


def test_kafka_feed_needs_the_connector(spark):
    import pytest
    with pytest.raises(Exception) as e:
        drain.kafka_feed(spark, "localhost:1", "t")
    assert "kafka" in str(e.value).lower()


def test_unparsable_and_empty_files(spark, tmp_path):
    root = str(tmp_path)
    p = paths(root)
    os.makedirs(p.landing, exist_ok=True)
    with open(os.path.join(p.landing, "post_detail_2024-03-26_10-00-00.json"), "w") as f:
        f.write('[{"id": "a", "message": "cut off')
    write(p.landing, "post_detail_2024-03-26_11-00-00.json", [])
    write(p.landing, "post_detail_2024-03-26_12-00-00.json", [post("b", ["y"])])
    jobs.ingest(spark, p, dataset_id=1)
    assert [r["id"] for r in read_bronze(spark, p.bronze).collect()] == ["b"]
    failed = spark.read.parquet(p.audit).filter("status = 'Failed'").collect()
    assert [r["error_message"] for r in failed] == \
        ["File post_detail_2024-03-26_10-00-00.json holds no post"]
    assert spark.read.json(p.quarantine).count() == 1


def test_incremental_gold_equals_full_refresh(spark, tmp_path):
    from feedlens.sources import tables as tb
    from tests.conftest import SF_SMALL
    root = str(tmp_path)
    feed = tb.comment_feed(spark, SF_SMALL)
    # three batches by event id, with comment dates overlapping across batches
    b = (F.substring("comment_id", 2, 20).cast("long") % 3).cast("string")
    for k in ("0", "1", "2"):
        jobs.refresh_gold_incremental(spark, feed.filter(b == k), f"b{k}", f"{root}/partials", f"{root}/gold")
    jobs.refresh_gold_incremental(spark, feed.filter(b == "1"), "b1", f"{root}/partials", f"{root}/gold")  # replay
    inc = {str(r["comment_date"]): r.asDict() for r in jobs.read_gold(spark, f"{root}/gold").collect()}
    jobs.refresh_gold(spark, feed, f"{root}/gold_full")
    full = {str(r["comment_date"]): r.asDict() for r in jobs.read_gold(spark, f"{root}/gold_full").collect()}
    assert inc == full and len(full) == 30


def test_gold_stream_equals_full_refresh(spark, tmp_path):
    from feedlens.sources import tables as tb
    from tests.conftest import SF_SMALL
    root = str(tmp_path)
    feed = tb.comment_feed(spark, SF_SMALL).select("comment_id", "comment_message", "comment_created_time")
    half = F.substring("comment_created_time", 9, 2).cast("int") <= 15
    feed.filter(half).write.parquet(f"{root}/silver/part=1")
    args = (f"{root}/silver", feed.schema, f"{root}/partials", f"{root}/gold", f"{root}/gcp")
    jobs.start_gold_stream(spark, *args, max_files_per_trigger=1).awaitTermination()
    feed.filter(~half).write.parquet(f"{root}/silver/part=2")  # later files: a second run picks them up
    jobs.start_gold_stream(spark, *args).awaitTermination()
    got = {str(r["comment_date"]): r.asDict() for r in jobs.read_gold(spark, f"{root}/gold").collect()}
    jobs.refresh_gold(spark, feed, f"{root}/gold_full")
    full = {str(r["comment_date"]): r.asDict() for r in jobs.read_gold(spark, f"{root}/gold_full").collect()}
    assert got == full and len(full) == 30


def test_full_gold_refresh_drops_stale_dates(spark, tmp_path):
    from feedlens.sinks import tables as sinks
    root = str(tmp_path)
    old = spark.createDataFrame([("2024-03-25", 1)], "d string, n int").withColumn("comment_date", F.to_date("d"))
    new = spark.createDataFrame([("2024-03-26", 2)], "d string, n int").withColumn("comment_date", F.to_date("d"))
    sinks.write_gold(old.drop("d"), f"{root}/g")
    sinks.write_gold(new.drop("d"), f"{root}/g", only_present=True)
    assert spark.read.parquet(f"{root}/g").count() == 2  # dynamic: the other date stays
    sinks.write_gold(new.drop("d"), f"{root}/g")
    assert [str(r["comment_date"]) for r in spark.read.parquet(f"{root}/g").collect()] == ["2024-03-26"]


def test_batch_with_a_failing_rule_is_not_promoted(spark, tmp_path):
    root = str(tmp_path)
    batch = spark.createDataFrame([("c1", "2024-03-26", None), ("c2", "2024-03-26", "ok")],
                                  "id string, file_date string, comment_message string")
    pending = spark.createDataFrame(
        [(11, "comment_message", "column_null_validation", "STRING", None),
         (12, "missing_col", "column_null_validation", "STRING", None)],
        "dcv_id long, column_name string, validation_name string, column_datatype string, "
        "validation_parameters string")
    status = jobs.validate_and_audit(spark, batch, pending, "id", f"{root}/errors", f"{root}/silver",
                                     f"{root}/rule_audit", f"{root}/audit", 1, "2024-03-26 00:00:00")
    assert status == "Validation Failed"
    assert not os.path.exists(f"{root}/silver")
    assert spark.read.parquet(f"{root}/errors").count() == 1  # the rule that ran recorded its error
    ra = {r["dataset_column_validation_id"]: (r["status"], r["error_message"])
          for r in spark.read.parquet(f"{root}/rule_audit").collect()}
    assert ra == {11: ("Validation Passed", "1 error rows"), 12: ("Failed", "Column missing_col not found")}
    aud = spark.read.parquet(f"{root}/audit").collect()[0]
    assert (aud["status"], aud["error_message"]) == ("Validation Failed", "Column missing_col not found")


def test_kafka_publish_needs_the_connector(spark):
    import pytest
    from feedlens.sources import messages
    recs = messages.encode(spark.createDataFrame([(1, "a")], "id long, s string"), "id", "t")
    with pytest.raises(Exception) as e:
        drain.publish(recs, "localhost:1", "t")
    assert "kafka" in str(e.value).lower()
