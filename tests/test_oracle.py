"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import pytest

import __spark_entry__ as se
from feedlens.plans.queries import QUERIES
from tools.compare import digest, duck

from .conftest import SF_CHECK

# the training-data queries have their tests beside them
SQL = {k: v for k, v in se.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    ours = digest(QUERIES[name](spark, SF_CHECK).toPandas())
    theirs = digest(con.sql(SQL[name]).df())
    assert ours == theirs


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["comment_date", "total_comments", "promoters", "detractors",
                          "csat_positive", "NPS", "CSAT"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["daily_nps_csat", "usage_cost", "file_stamp_parse",
                                  "quarantine_split", "audit_current", "stream_to_bronze"])
def test_matches_oracle_in_another_time_zone(spark, con, name):
    """Results do not depend on the session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ours = digest(QUERIES[name](spark, SF_CHECK).toPandas())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ours == digest(con.sql(SQL[name]).df())
