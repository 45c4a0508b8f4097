"""Multi-line JSON files in byte ranges of any size, against the json module."""

import json
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from feedlens.plans import jobs
from feedlens.sources import fixtures, json_split
from feedlens.streaming.ingest import IngestPaths, read_bronze

from .test_stream import post

TRICKY = ["a", "x}y", 'q"uo{te', "back\\", '\\"}', "é漢\n{", '[{"a":1}]', "", "}{\"", "  tab\t"]


@pytest.fixture
def ranges(spark):
    """Sets the bytes a task reads at most."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]

    def use(size):
        spark.conf.set(keys[0], size)
        spark.conf.set(keys[1], "1b")
    yield use
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)


def found(spark, folder):
    out = {}
    for r in json_split.split_elements(json_split.read_pieces(spark, folder)).collect():
        out.setdefault(os.path.basename(r["source_file"]), []).append(r["_raw"])
    return out


def same(texts, elements):
    def key(raw):
        try:
            return json.dumps(json.loads(raw), sort_keys=True) if raw is not None else "null"
        except ValueError:
            return json.dumps(raw)
    return sorted(map(key, texts)) == sorted(json.dumps(e, sort_keys=True) for e in elements)


def thing(rng, k, depth=0):
    out = {"id": f"i{k}", "s": rng.choice(TRICKY), "n": k}
    if depth < 2 and rng.random() < 0.6:
        out["c"] = [thing(rng, k * 10 + j, depth + 1) for j in range(rng.randint(0, 3))]
    if rng.random() < 0.3:
        out["e"] = {}
    return out


@pytest.mark.parametrize("size", ["64m", "50b", "333b", "5k"])
def test_elements_in_ranges_of_any_size(spark, tmp_path, ranges, size):
    ranges(size)
    rng = random.Random(1)
    want = {}
    for f in range(6):
        elements = [thing(rng, k) if f % 3 == 2 or rng.random() < 0.9 else rng.choice([1, 2.5, "s{tr", None, True]) for k in range(40)]
        text = (json.dumps(elements, indent=2) if f % 3 == 0 else json.dumps([elements[:20], elements[20:]], ensure_ascii=False) if f % 3 == 1
                else "\n".join(map(json.dumps, elements)) + "\n" * (f == 2))
        write(str(tmp_path), f"f{f}.json", text)
        want[f"f{f}.json"] = elements
    write(str(tmp_path), "empty.json", "")
    write(str(tmp_path), "nothing.json", " [\n]\n")
    got = found(spark, str(tmp_path))
    assert set(got) == set(want) and all(same(got[f], want[f]) for f in want)
    if size == "50b":
        assert json_split.read_pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 100


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from(["a", "b}", '"{']), st.recursive(
    st.none() | st.integers(-9, 9) | st.sampled_from(TRICKY), lambda x: st.lists(x, max_size=2) | st.dictionaries(st.sampled_from(["k", "}"]), x, max_size=2),
    max_leaves=6), min_size=1, max_size=2), max_size=8), st.sampled_from([None, 1]), st.booleans())
def test_elements_of_any_objects(spark, tmp_path, ranges, elements, indent, cut):
    ranges("20b")
    folder = str(tmp_path / os.urandom(4).hex())
    text = json.dumps(elements, indent=indent)
    write(folder, "f.json", "﻿" + text if cut else text)
    assert same(found(spark, folder).get("f.json", []), elements)


@pytest.mark.parametrize("size", ["64m", "30b"])
def test_files_that_are_cut_off_keep_all_their_text(spark, tmp_path, ranges, size):
    ranges(size)
    whole = [{"id": k, "s": "a}b", "in": {"x": [1]}} for k in range(5)]
    text = json.dumps(whole)
    for cut in range(1, len(text)):
        write(str(tmp_path), f"cut{cut:03d}.json", text[:cut])
    got = found(spark, str(tmp_path))
    for cut in range(1, len(text)):
        raws = got.get(f"cut{cut:03d}.json", [])
        n = sum(len(json.dumps(whole[:k])) - 1 <= cut for k in range(1, 6))
        assert same(raws[:0], []) and sum(_is_one(r, whole) for r in raws) == n, cut
        rest = "".join(r for r in raws if not _is_one(r, whole))
        tail = text[:cut][len(json.dumps(whole[:n])) - 1 if n else 0:]
        assert sorted(rest) == sorted(tail) or tail.strip("[], ") == "" == rest, (cut, rest, tail)


def _is_one(raw, whole):
    try:
        return json.loads(raw) in whole
    except ValueError:
        return False


def test_a_large_file_is_read_by_many_tasks_and_lands_as_by_lines(spark, tmp_path, ranges):
    """One array of arrays over many byte ranges gives the bronze rows that the line layout gives."""
    ranges("2k")
    posts = [post(f"p{k}", [f"text {k} }}" * 3, None], extra={"channel": "w{b"} if k % 7 == 0 else None) for k in range(120)]
    name = "post_detail_2024-03-26_10-00-00.json"
    write(f"{tmp_path}/json/landing", name, json.dumps([posts[:50], posts[50:]], indent=1))
    write(f"{tmp_path}/lines/landing", name, "\n".join(map(json.dumps, posts)))
    rows = []
    for layout in ("json", "lines"):
        root = f"{tmp_path}/{layout}"
        paths = IngestPaths(f"{root}/landing", f"{root}/bronze", f"{root}/quarantine", f"{root}/audit", f"{root}/checkpoint")
        jobs.ingest(spark, paths, 1, layout=layout)
        rows.append(sorted(read_bronze(spark, paths.bronze).drop("source_file", "landed_at").toJSON().collect()))
    assert len(rows[0]) == 120 and rows[0] == rows[1]
    assert json_split.read_pieces(spark, f"{tmp_path}/json/landing").rdd.getNumPartitions() > 10


def test_a_byte_range_is_put_together_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(json_split, "SECTION_BITS", 3, raising=False)
    monkeypatch.setattr(json_split, "TASK_BYTES", 1 << 10, raising=False)
    rng = random.Random(2)
    elements = [thing(rng, k) for k in range(150)]
    write(str(tmp_path), "f.json", json.dumps(elements, indent=1))
    frames = []
    rows = json_split.split_elements(json_split.read_pieces(spark, str(tmp_path)), frames).collect()
    assert same([r["_raw"] for r in rows], elements)
    shares = [r["count"] for r in frames[-1].groupBy(F.spark_partition_id()).count().collect()]
    assert len(shares) > 5 and max(shares) < sum(shares) / 2
    for frame in frames:
        frame.unpersist()


def test_a_day_of_many_posts_lands_in_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "JSON_FILE_POSTS", 20, raising=False)
    sf = "/root/testdata/sf0.001"
    fixtures.write_json_landing(spark, sf, str(tmp_path))
    texts = [f.read_text() for f in tmp_path.glob("*/*.txt")]
    flat = [e for t in texts for x in json.loads(t) for e in (x if isinstance(x, list) else [x])]
    ids = sorted(e["id"] for e in flat if isinstance(e, dict))
    assert ids == sorted(r["id"] for r in fixtures.posts(spark, sf).select("id").collect())
    assert len(texts) > fixtures.posts(spark, sf).select("day").distinct().count()
