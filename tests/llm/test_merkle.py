"""Operator 10: its SQL twin, the edited text, and what likeness tells."""

import hashlib
import random

import duckdb
import pandas as pd

from feedlens.llm import merkle
from feedlens.llm.common import table
from tests.conftest import SF_SMALL, plan_text

from .conftest import SCHEMA, table_of, words


def test_equals_its_sql_and_a_plain_edit(spark, odd_rows):
    rows = [r for r in dict.fromkeys(odd_rows)]
    got = merkle.fingerprints(spark.createDataFrame(rows, SCHEMA))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64"}))
    want = con.sql(merkle.SQL).df().astype(object).where(lambda d: d.notna(), None)
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        [(None if r[0] is None else int(r[0]), int(r[1]), *r[2:]) for r in want[got.columns].itertuples(index=False)], key=key)
    order = sorted(rows, key=key)
    by_id = {r["doc_id"]: r for r in got.collect()}
    for k, (doc, text, *_) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 2
        edited = text[:len(text) - cut] + after[:cut]
        assert by_id[doc]["n_chars"] == len(text)
        assert by_id[doc]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_repeated_rows_and_many_ranges(spark):
    rng = random.Random(2)
    rows = [(k // 2, words(rng, 30), None, None, None) for k in range(300)] + [(7, "same", None, None, None)] * 3
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = merkle.fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(5))
        assert got.count() == len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_likeness_follows_the_edit(spark):
    rng = random.Random(3)
    text = "\n".join(words(rng, 25) for _ in range(40))
    lines = text.split("\n")
    lines[20] = words(rng, 25)
    other = "\n".join(words(rng, 25) for _ in range(40))
    rows = [(1, text, None, None, None), (2, "\n".join(lines), None, None, None), (3, other, None, None, None), (4, other, None, None, None)]
    got = {r["doc_id"]: r for r in merkle.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert 0.9 < got[1]["near_next"] < 1 and got[2]["near_next"] < 0.02 and got[3]["near_next"] == 1
    assert got[3]["fingerprint"] == got[4]["fingerprint"] != got[1]["fingerprint"]
    parts = [got[k]["fingerprint"].split("/")[1].split(",") for k in (1, 2)]
    assert 0 < len(set(parts[0]) & set(parts[1])) < len(parts[0])  # the sections that differ locate the edit


def test_lone_row_empty_table_clashing_columns(spark, nothing, odd, clashing):
    got = merkle.fingerprints(spark.createDataFrame([(1, "abcd", None, None, None)], SCHEMA)).first()
    assert got["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and got["near_next"] == 1
    assert merkle.fingerprints(nothing).count() == 0
    assert table_of(merkle.fingerprints(clashing)) == table_of(merkle.fingerprints(odd))


def test_no_python_in_the_plan(spark):
    plan = plan_text(merkle.fingerprints(table(spark, SF_SMALL, "documents")))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
