"""File names, quarantine, message decode/encode, rescue."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.sinks import tables as sinks
from feedlens.sources import files, messages

NAMES = {
    "/l/post_detail_2024-03-26_10-00-00.json": ("2024-03-26_10-00-00", "2024", "03", "26", True),
    "/l/post_detail_2024-03-26.json": ("", "", "", "", False),
    "/l/post_detail_2024-03-26_10-00-00.json.bak": ("2024-03-26_10-00-00", "2024", "03", "26", False),
    "/l/post_detail_2024-13-26_10-00-00.json": ("2024-13-26_10-00-00", "2024", "13", "26", False),
    "/l/x_post_detail_2024-03-26_10-00-00.json": ("2024-03-26_10-00-00", "2024", "03", "26", False),
}


def test_stamp_and_name_checks(spark):
    df = spark.createDataFrame([(p,) for p in NAMES], "source_file string")
    out = {r["source_file"]: r for r in files.with_file_columns(df).collect()}
    for p, (stamp, y, m, d, ok) in NAMES.items():
        r = out[p]
        assert (r["file_date"], r["year"], r["month"], r["day"], r["name_ok"]) == (stamp, y, m, d, ok), p
        assert r["filename"] == p.rsplit("/", 1)[1]
    assert out["/l/post_detail_2024-13-26_10-00-00.json"]["batch_ts"] is None


def test_quarantine_split_and_report(spark):
    rows = [(p, i) for i, p in enumerate(NAMES)] + [("/l/post_detail_2024-03-26_10-00-00.json", 9)]
    df = files.with_file_columns(spark.createDataFrame(rows, "source_file string, n int"))
    ok, bad = files.quarantine_split(df)
    assert ok.count() == 2 and bad.count() == 4
    assert bad.filter(F.col("file_date").isNotNull()).count() == 0
    rep = {r["filename"]: r for r in files.file_report(df).collect()}
    good = rep["post_detail_2024-03-26_10-00-00.json"]
    assert good["status"] == "Accepted" and good["n_rows"] == 2 and str(good["business_date"]) == "2024-03-26"
    assert rep["post_detail_2024-03-26.json"]["error_message"] == \
        "Filename post_detail_2024-03-26.json format mismatch"


def test_decode_keeps_malformed_values(spark):
    msgs = spark.createDataFrame(
        [(b"h", b'{"k": 1}', "t", 0, 5), (None, b"oops{", "t", 1, 6), (b"h", b'{"k": 2, "z": 3}', "t", 0, 7)],
        "key binary, value binary, topic string, partition int, offset long")
    out = {r["offset"]: r for r in messages.decode(msgs, T.StructType([T.StructField("k", T.LongType())])).collect()}
    assert out[5]["k"] == 1 and out[5]["is_valid"] and out[5]["key"] == "h"
    assert out[6]["k"] is None and not out[6]["is_valid"] and out[6]["key"] is None
    assert out[6]["raw_value"] == "oops{"
    assert out[7]["k"] == 2 and out[7]["is_valid"]


def test_encode_round_trip(spark):
    recs = spark.createDataFrame([(1, "a", 10)], "id long, name string, n long")
    enc = messages.encode(recs, "id", "topic1")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])
    dec = messages.decode(enc.withColumns({"partition": F.lit(0), "offset": F.lit(0)}), schema).collect()[0]
    assert (dec["key"], dec["name"], dec["n"], dec["topic"]) == ("1", "a", 10, "topic1")


def test_rescue_unknown_keys(spark):
    raw = spark.createDataFrame([('{"k": 1}',), ('{"k": 2, "b": 1, "a": {"x": 1}}',), ("bad",)], "raw string")
    out = messages.rescue(raw, "raw", T.StructType([T.StructField("k", T.LongType())])).collect()
    got = {r["raw"]: (r["k"], r["_rescued"]) for r in out}
    assert got['{"k": 1}'] == (1, None)
    assert got['{"k": 2, "b": 1, "a": {"x": 1}}'] == (2, '{"a":{"x":1},"b":1}')
    assert got["bad"] == (None, None)


def test_rescue_keeps_values_nested_and_mistyped(spark):
    from feedlens import schemas
    raw = [
        ('{"id": "a", "message": 5, "likes": {"summary": {"total_count": "many", "x": null}}}', '{"likes":{"summary":{"total_count":"many","x":null}}}'),
        ('{"id": "b", "comments": {"data": [{"id": "c"}, {"id": "d", "mood": ["up"]}]}}', '{"comments":{"data":[null,{"mood":["up"]}]}}'),
        # an element of another type costs the parse its whole array, so all of it is kept
        ('{"id": "e", "comments": {"data": [{"id": "c"}, 7]}}', '{"comments":{"data":[{"id":"c"},7]}}'),
        ('{"id": "c", "comments": [1], "from": "me"}', '{"comments":[1],"from":"me"}'),
        ('{"id": "d", "comments": {"data": null}, "likes": null}', None), ('{}', None), ('[1]', None), (None, None)]
    out = messages.rescue(spark.createDataFrame([(r,) for r, _ in raw], "raw string"), "raw", schemas.POST).collect()
    assert [(r["raw"], r["_rescued"]) for r in out] == raw
    assert out[0]["message"] == "5" and out[0]["likes"]["summary"]["total_count"] is None


def test_landing_folders_count_as_files(spark):
    paths = ["file:/l/drain=q-0/landing_file=post_detail_2024-03-26_10-00-00.json/part-0-x.txt", "/l/post_detail_2024-03-26.json"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(
        files.landing_path("p").alias("source_file"), files.part_name("p").alias("part"))
    got = files.with_file_columns(df).collect()
    assert [(r["filename"], r["part"], r["name_ok"]) for r in got] == [
        ("post_detail_2024-03-26_10-00-00.json", "part-0-x.txt", True), ("post_detail_2024-03-26.json", None, False)]


def test_same_partitions_matches_null(spark):
    stored = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "n int, d string")
    pick = lambda values: sorted(r["n"] for r in files.same_partitions(
        stored, spark.createDataFrame([(v,) for v in values], "d string"), "d").collect())
    assert pick(["a", None, None]) == [1, 2] and pick(["b", "c"]) == [3] and pick([]) == []


def test_only_a_missing_table_counts_as_not_written(spark, tmp_path):
    import pytest
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    assert files.read_if_exists(spark, str(tmp_path / "none"), schema) is None
    with pytest.raises(Exception):
        files.read_if_exists(spark, "nosuchscheme://x/y", schema)


def test_registry_row_and_table_exists(spark):
    import pytest
    from feedlens import schemas
    reg = spark.createDataFrame(
        [tuple([1, "post_detail", "facebook"] + [None] * (len(schemas.DATASET.fields) - 3)),
         tuple([2, "post_detail", "instagram"] + [None] * (len(schemas.DATASET.fields) - 3))],
        schemas.DATASET)
    assert files.registry_row(reg, "post_detail", "facebook")["id"] == 1
    with pytest.raises(LookupError):
        files.registry_row(reg, "missing", "facebook")
    reg.createOrReplaceTempView("feedlens_registry_probe")
    assert files.table_exists(spark, "feedlens_registry_probe")
    assert not files.table_exists(spark, "feedlens_no_such_table")


def test_default_business_date(spark):
    import datetime as dt
    from feedlens.functions.dates import default_business_date
    r = spark.range(1).select(default_business_date().alias("d"), F.current_date().alias("t")).collect()[0]
    assert r["t"] - r["d"] == dt.timedelta(days=1)


def test_read_registered_batch_prunes_to_one_day(spark, tmp_path):
    from feedlens.sinks import tables as sinks
    from tests.conftest import plan_text
    rows = [("a", "2024", "03", "26", "f1"), ("b", "2024", "03", "27", "f2"), ("c", "2024", "03", "26", "f3")]
    df = spark.createDataFrame(rows, "id string, year string, month string, day string, filename string")
    schema = df.schema
    for fmt in ("json", "csv"):
        path = str(tmp_path / fmt)
        sinks.write_bronze(df, path, fmt)
        got = files.read_registered_batch(spark, {"format": fmt, "bronze_path": path}, "2024-03-26", schema)
        assert sorted(r["id"] for r in got.collect()) == ["a", "c"]
        assert "PartitionFilters: [isnotnull(year" in plan_text(got, "simple")


def test_csv_batch_without_schema_infers_types(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string").write.option("header", "true").csv(path)
    df = files.read_batch(spark, "csv", path)
    assert dict(df.dtypes) == {"n": "int", "s": "string"} and df.count() == 2


def test_registry_row_rejects_duplicates(spark):
    import pytest
    from feedlens import schemas
    n = len(schemas.DATASET.fields)
    reg = spark.createDataFrame([tuple([i, "post_detail", "facebook"] + [None] * (n - 3)) for i in (1, 2)],
                                schemas.DATASET)
    with pytest.raises(LookupError):
        files.registry_row(reg, "post_detail", "facebook")


def test_a_csv_bronze_file_holds_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "CSV_FILE_ROWS", 10, raising=False)
    rows = spark.range(35).select(F.col("id").cast("string").alias("id"), F.lit("a\nb").alias("message"), *[
        F.lit(v).alias(c) for c, v in zip(sinks.BRONZE_PARTITIONS, ("2024", "03", "26", "f.json"))])
    sinks.write_bronze(rows, str(tmp_path), "csv")
    got = spark.read.options(**sinks.CSV_OPTIONS).csv(str(tmp_path)).groupBy(F.col("_metadata.file_path").alias("f")).count().collect()
    assert sum(r["count"] for r in got) == 35 and max(r["count"] for r in got) <= 10


def test_a_write_task_gets_a_bounded_part_of_a_partition(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "WRITE_BYTES", 4 << 10, raising=False)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    given = spark.conf.get(key)
    rows = spark.range(20_000, numPartitions=10).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("x").alias("p"))
    sinks.write_partitions(rows, str(tmp_path), ["p"])
    back = spark.read.parquet(str(tmp_path))
    assert len(back.inputFiles()) > 5 and back.count() == 20_000 and spark.conf.get(key) == given
    spark.conf.set(key, "2k")  # a session that asks for less gets less
    try:
        with sinks.write_sizes(spark):
            assert spark.conf.get(key) == "2048"
    finally:
        spark.conf.set(key, given)
