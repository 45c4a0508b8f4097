"""Operator 2 against all pairs."""

import random
from itertools import combinations

import pytest
from pyspark.sql import Row

from feedlens.llm import lsh_forest
from feedlens.llm.components import components

from .conftest import SCHEMA, table_of, words


def plain(rows):
    """(n_shingles, component) of each row by comparing all pairs of whole sets; rows of one id are one document."""
    sets, parent = {}, {}
    for k, (doc, text, *_) in enumerate(rows):
        if doc is not None:
            w = (text or "").encode().lower().split()
            sets[doc, k] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
            parent[doc] = doc

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = top(a[0]), top(b[0])
            parent[max(x, y)] = min(x, y)
    return [(doc, len(found), top(doc) if found else doc) for (doc, _), found in sets.items()]


def check(spark, rows):
    got = lsh_forest.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] is None and r["kept"] if r["doc_id"] is None else r["kept"] == (r["doc_id"] == r["component_id"])
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == sorted(plain(rows))


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = words(rng, 1)
    return " ".join(w)


def test_odd_rows(spark, odd_rows):
    check(spark, odd_rows)


def test_one_id_with_several_texts(spark):
    """A link of any text of an id links the id."""
    rng = random.Random(3)
    a, b, c = (words(rng, 60) for _ in range(3))
    rows = [(1, a), (1, b), (2, edited(rng, a, 1)), (3, edited(rng, b, 1)), (4, c), (4, ""), (0, edited(rng, c, 1)), (4, c), (5, None), (5, "x y")]
    check(spark, [(*r, "en", "s", 1) for r in rows])


def test_signatures_of_a_link_agree():
    """The stated probability that a pair at the threshold agrees in fewer than AGREE of its signature's values."""
    from math import comb

    assert sum(comb(64, k) * 0.75**k * 0.25**(64 - k) for k in range(lsh_forest.AGREE)) < 1e-5


@pytest.mark.parametrize("chunk, rows, shingles, dense", [(512, 1024, 1 << 19, 16), (8, 7, 1500, 1000), (16, 8, 1 << 19, 1), (16, 1024, 200, 2)])
def test_dense_groups_common_passages_and_chains(spark, monkeypatch, chunk, rows, shingles, dense):
    """A star of near copies, texts around a common passage, and a chain of edits; with small chunks and units, with regions counted as
    dense early, and with clusters."""
    for name, value in (("CHUNK", chunk), ("UNIT_ROWS", rows), ("UNIT_SHINGLES", shingles), ("DENSE", dense)):
        monkeypatch.setattr(lsh_forest, name, value)
    rng = random.Random(9)
    texts = []
    hub = words(rng, 150)
    texts += [hub] * 5 + [edited(rng, hub, 4) for _ in range(60)]
    passage = words(rng, 60)
    texts += [passage + " " + words(rng, 12 + k % 9) for k in range(60)]
    link = words(rng, 120)
    for _ in range(15):
        texts.append(link)
        link = edited(rng, link, 2)
    texts += [words(rng, 40) for _ in range(40)]
    rng.shuffle(texts)
    check(spark, [(k, t, "en", "s", 1) for k, t in enumerate(texts)])


def test_empty_table_and_clashing_columns(nothing, odd, clashing):
    assert lsh_forest.near_duplicates(nothing).count() == 0
    assert table_of(lsh_forest.near_duplicates(clashing)) == table_of(lsh_forest.near_duplicates(odd))


def test_a_table_without_any_pair(spark):
    rows = [(1, "a b c d e f", None, None, None), (2, None, None, None, None)]
    assert table_of(lsh_forest.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == [(1, 2, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_edges(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([Row(a=a, b=b) for a, b in edges])).collect()}
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: top(x) for x in parent if x not in loops}
