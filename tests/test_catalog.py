"""Bucketed catalog tables: same rows as the path tables, and the stored side lies still."""

import re

import pytest

from feedlens.operators import quality, upsert
from feedlens.sinks import catalog
from feedlens.sources import files

from .conftest import plan_text

ERRORS = "id long, a string, error_message string"


@pytest.fixture
def names(spark, request):
    names = [f"t_{abs(hash(request.node.name)) % 10**8}_{k}" for k in range(2)]
    yield names
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def exchanges_below_scan(df, table):
    """Whether the physical plan moves the rows of a table: an exchange above its scan before any join."""
    plan = plan_text(df, "simple")
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if "FileScan" in line and table in line)
    depth = len(re.match(r"[\s:+\-|]*", lines[at]).group())
    for line in reversed(lines[:at]):
        d = len(re.match(r"[\s:+\-|]*", line).group())
        if d < depth:
            depth = d
            if "Join" in line:
                return False
            if "Exchange" in line:
                return True
    return False


def test_upsert_equals_the_plain_one_and_is_repeatable(spark, names):
    table = names[0]
    parts = [[(1, "x", "m1"), (2, None, "m1"), (None, "n", "m1")], [(1, "x", "m2"), (3, "y", "m1"), (None, "n", "m0")], [(1, "z", "m1"), (2, None, "m1")]]
    want = None
    for rows in [*parts, parts[1]]:
        source = spark.createDataFrame(rows, ERRORS)
        catalog.upsert_errors(source, table, "id", buckets=4)
        want = upsert.upsert_errors(want, source)
        assert sorted(map(tuple, catalog.stored(spark, table).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert catalog.bucket_count(spark, table) == 4 and files.table_exists(spark, table) and not files.table_exists(spark, f"{table}_next")


def test_promotion_against_stored_errors(spark, names):
    batch = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (3, "w"), (3, "w")], "id long, a string")
    assert catalog.promote_valid(batch, names[0], "id").count() == 5  # no table yet
    catalog.append(spark.createDataFrame([(2, "y", "e"), (2, "q", "e"), (None, "z", "e")], ERRORS), names[0], "id")
    got = catalog.promote_valid(batch, names[0], "id")
    want = quality.promote_valid(batch, catalog.stored(spark, names[0]), "id")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr) and got.count() == 4
    with pytest.raises(ValueError, match="not bucketed"):
        spark.range(1).write.saveAsTable(names[1])
        catalog.bucket_count(spark, names[1])


def test_the_stored_side_is_not_shuffled(spark, names):
    stored = spark.range(5000).selectExpr("id", "cast(id as string) a", "'m' error_message")
    catalog.append(stored, names[0], "id", buckets=16)
    batch = spark.range(0, 5000, 7).selectExpr("id", "cast(id as string) a", "'m2' error_message")
    for df in (catalog.promote_valid(batch, names[0], "id"), catalog.merge_errors(batch, names[0], "id")):
        assert not exchanges_below_scan(df, names[0])
    plain = quality.promote_valid(batch, spark.read.parquet(files_of(spark, names[0])).hint("merge"), "id")
    assert exchanges_below_scan(plain, "parquet")  # the same join on a path table moves it


def files_of(spark, table):
    return spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Location'").collect()[0]["data_type"]
