"""Operator 8: exact round trips, revisits, splits at any byte."""

import base64
import hashlib
import io

import pytest

from feedlens.llm import warc

from .conftest import table_of

SCHEMA = "page_id bigint, url string, html string"
ROWS = [(3, "http://a/", "<p>same</p>"), (1, "http://b/", "<p>same</p>"), (2, None, "<p>é 漢</p>"), (4, "http://c/", None), (5, "", ""),
        (6, "http://d/\r\nX: y", "WARC/1.1\r\n\x1f\x8b\x08 not a record"), (7, "http://e/", "z" * 300_000), (None, "http://f/", "<p>same</p>"),
        (8, "http://g/", "<p>twice</p>"), (8, "http://g/", "<p>twice</p>")]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def want(rows):
    first = {}
    for page, _, text in rows:
        if page is not None:
            first[text or ""] = min(page, first.get(text or "", page))
    out = []
    for page, _, text in rows:
        lead = first[text or ""]
        response = page == lead
        out.append((page, len((text or "").encode()), digest(text), "response" if response else "revisit", None if response else lead))
    return sorted(out, key=repr)


def test_round_trip(spark):
    assert table_of(warc.round_trip(spark.createDataFrame(ROWS, SCHEMA))) == want(ROWS)


def test_smaller_payloads_are_always_responses(spark):
    got = warc.with_leaders(spark.createDataFrame(ROWS, SCHEMA), "page_id", "html", min_bytes=12).collect()
    assert {r["page"]: r["leader"] for r in got}[3] is None and {r["page"]: r["leader"] for r in got}[8] == 8


@pytest.mark.parametrize("split", [1, 7, 100, 1 << 20])
def test_every_record_is_owned_by_one_range(split):
    payloads = [b"", b"\x1f\x8b\x08\x1f\x8b\x08" * 50, bytes(range(256)) * 40, b"plain"]
    data = b"junk \x1f\x8b\x08 junk" + b"".join(warc.record("response", k, f"http://{k}/", p, None) for k, p in enumerate(payloads))
    found = [r for a in range(0, len(data), split) for r in warc.records_in(io.BytesIO(data), len(data), a, min(len(data), a + split))]
    assert [(int(r[1]), r[6]) for r in found] == list(enumerate(payloads))


def test_damaged_payload_is_an_error():
    import gzip
    data = gzip.decompress(warc.record("response", 1, "u", b"payload", None)).replace(b"payload\r\n", b"PAYLOAD\r\n")
    with pytest.raises(ValueError):
        warc.parse(data)


def test_records_carry_urls_and_payloads(spark):
    from feedlens.llm.common import cut, fresh_folder
    files = cut(warc.write(spark.createDataFrame(ROWS, SCHEMA), fresh_folder(spark, "warc-test")))
    rows = {r["record_id"]: r for r in warc.read(spark, files, split_bytes=500).collect()}
    assert bytes(rows["2"]["payload"]).decode() == "<p>é 漢</p>" and rows["3"]["payload"] is None and rows["3"]["refers_to"] == "1"
    assert rows["6"]["url"] == "http://d/  X: y"


def test_empty_table_and_clashing_columns(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    more = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 as page", "2 as body", "3 as leader", "4 as sha", "5 as size")
    assert table_of(warc.round_trip(more)) == want(ROWS)


@pytest.mark.parametrize("size", [1000, 70_000, 500_000])
def test_a_header_of_any_length_is_read(size):
    import random
    url = "http://" + random.Random(size).randbytes(size // 2).hex()
    data = b"".join(warc.record("response", k, url, b"payload %d" % k, None) for k in range(3))
    found = [r for a in range(0, len(data), 5000) for r in warc.records_in(io.BytesIO(data), len(data), a, min(len(data), a + 5000))]
    assert [(int(r[1]), r[2], r[6]) for r in found] == [(k, url, b"payload %d" % k) for k in range(3)]


def test_a_record_that_is_not_read_is_an_error(spark, monkeypatch):
    plain = warc.read
    monkeypatch.setattr(warc, "read", lambda *a: plain(*a).where("record_id <> '4'"))
    with pytest.raises(RuntimeError):
        warc.round_trip(spark.createDataFrame(ROWS, SCHEMA))
