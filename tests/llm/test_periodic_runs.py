"""Operator 11 against a plain search for every period, and the grammar's extensions against comparing word by word."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from feedlens.llm import periodic_runs as pr
from feedlens.llm.recompression import BACKWARD, FORWARD, Grammar

from .conftest import table_of, words


def brute_runs(w, min_length):
    """Maximal stretches of each period; the smallest period names a stretch."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(min_length, 2 * q):
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w, 12)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    collapsed = " ".join(x for k, x in enumerate(w) if k not in dropped)
    return (doc_id, len(runs), *head, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=6), st.integers(2, 12))
def test_runs_equal_brute_force(docs, min_length):
    found = pr.runs_of([np.array(d, dtype=np.int64) for d in docs], min_length)
    assert [[tuple(r) for r in f.tolist()] for f in found] == [brute_runs(d, min_length) for d in docs]


def test_grammar_extensions_equal_comparing():
    rng = np.random.default_rng(0)
    for n, kinds in ((30, 2), (200, 2), (400, 1), (300, 6)):
        text = np.concatenate(([90], np.tile(rng.integers(0, kinds, n // 3), 3), [91]))
        text[rng.integers(1, len(text) - 1, 3)] = rng.integers(0, kinds, 3)
        i, j = rng.integers(1, len(text) - 1, (2, 500))
        i, j = i[i != j], j[i != j]
        for direction in (FORWARD, BACKWARD):
            def plain(a, b):
                same = 0
                while text[a] == text[b]:
                    a, b, same = a + direction, b + direction, same + 1
                return same
            assert Grammar(text).extensions(i, j, direction).tolist() == [plain(a, b) for a, b in zip(i.tolist(), j.tolist())]


def test_a_document_beyond_the_ready_grid(monkeypatch):
    monkeypatch.setattr(pr, "GRID_WORDS", 16)
    pr.ready_grid.cache_clear()
    rng = random.Random(8)
    docs = [[rng.randrange(3) for _ in range(150)] + [0, 1, 2] * 40, [7] * 100, [rng.randrange(2) for _ in range(90)]]
    found = pr.runs_of([np.array(d, dtype=np.int64) for d in docs])
    pr.ready_grid.cache_clear()
    assert [[tuple(r) for r in f.tolist()] for f in found] == [brute_runs(d, 12) for d in docs]


def test_op11_equals_brute_force_on_odd_rows(spark, odd, odd_rows, clashing):
    rng = random.Random(1)
    more = [(200 + k, " ".join([words(rng, 4)] * rng.randint(1, 9)) + "\x85tail\xa0x\x1fy " + words(rng, 30)) for k in range(60)]
    rows = [(r[0], r[1]) for r in odd_rows] + more
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    want = sorted((brute_row(d, t) for d, t in rows), key=repr)
    assert table_of(pr.periodic_runs(df)) == want
    assert sum(r[1] for r in want) > 20
    assert table_of(pr.periodic_runs(clashing)) == table_of(pr.periodic_runs(odd))


def test_op11_empty_table_and_own_texts(spark, nothing):
    assert pr.periodic_runs(nothing).collect() == []
    df = spark.createDataFrame([(k, "a b c d " * 10) for k in range(40)], "doc_id bigint, text string")
    rows = pr.periodic_runs(df, plant=False).collect()
    assert {(r.n_runs, r.start, r.length, r.period, r.exponent_milli) for r in rows} == {(1, 0, 40, 4, 10000)}
    assert {r.collapsed_sha256 for r in rows} == {hashlib.sha256(b"a b c d").hexdigest()}


@pytest.mark.parametrize("n", [30_000, 100_000])
def test_long_repeats_stay_fast(n):
    assert [r.tolist() for r in pr.runs_of([np.zeros(n, dtype=np.int64)])] == [[[0, n, 1]]]
