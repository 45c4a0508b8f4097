"""Operator 5 against brute force."""

import numpy as np
import pytest

from feedlens.llm import rp_forest

from .conftest import table_of

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k, every):
    use = {}
    for key, v, *_ in rows:
        if key is not None and v and None not in v and np.isfinite(v).all() and any(v):
            use.setdefault(key, np.array(v, dtype=np.float32).astype(float))
    out = {}
    for q in use:
        if q % every == 0:
            scores = sorted(((-float((use[q] * v).sum()), key) for key, v in use.items() if key != q))
            out[q] = [(key, -s) for s, key in scores[:k]]
    return out


def compare(got, want):
    """Exact ranks and scores of what was found; recall."""
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == {q for q, v in want.items() if v}
    hits = total = 0
    for q, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(want[q]) + 1))
        assert [(-r["score"], r["vec_id"]) for r in rows] == sorted((-r["score"], r["vec_id"]) for r in rows)
        total += len(want[q])
        hits += len({r["vec_id"] for r in rows} & {key for key, _ in want[q]})
    return hits / max(1, total)


def test_odd_rows_and_ties(spark):
    v = [0.5, 0.25, -1.0]
    rows = [(0, v, 1), (1, v, 1), (2, v, 2), (3, [0.0, 0.0, 0.0], 1), (4, None, 1), (5, [], 1), (6, [1.0, None, 2.0], 1), (7, [float("nan"), 1.0, 1.0], 1),
            (8, [float("inf"), 1.0, 1.0], 1), (None, v, 1), (9, [1.0, 2.0], 1), (10, [2.0, 1.0, 0.0], None), (10, [2.0, 1.0, 0.0], None), (12, [-0.0, 3.0, 1.0], 1)]
    good = [r for r in rows if r[0] not in (9,)]
    for k in (2, 20):
        got = rp_forest.nearest(spark.createDataFrame(rows, SCHEMA), k=k, every=2).collect()
        want = brute(good, k, 2)
        assert compare(got, want) == 1
        assert {(r["query_id"], r["vec_id"]): r["score"] for r in got} == {(q, key): s for q, found in want.items() for key, s in found}


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_on_random_and_clustered_vectors(spark, monkeypatch, scaled):
    monkeypatch.setattr(rp_forest, "LEAF_ROWS", 40)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 24))
    x[500:1000] = x[500] + 0.05 * rng.normal(size=(500, 24))
    x[1000:1200] = x[1000]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scaled:
        x *= rng.uniform(0.2, 3, size=(1500, 1))
    rows = [(k, [float(a) for a in v], 0) for k, v in enumerate(x.astype(np.float32))]
    got = rp_forest.nearest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert compare(got, brute(rows, 20, 20)) >= 0.9


def test_empty_table_and_clashing_columns(spark):
    empty = rp_forest.nearest(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]
    rows = spark.createDataFrame([(k, [float(k), 1.0], 0) for k in range(30)], SCHEMA)
    more = rows.selectExpr("*", "1 as query_id", "'q' as class", "2 as vec", "3 as size", "4 as leaf")
    assert table_of(rp_forest.nearest(more)) == table_of(rp_forest.nearest(rows))


def test_a_walk_takes_leaves_by_falling_probability():
    right = [[0.9, 0.5, 0.2], [0.6, 0.5, 0.5]]
    found = rp_forest.walk(right, 2, 8, 0)
    chance = {(t, leaf): np.prod([p if bit else 1 - p for p, bit in zip((r[0], r[1 + (leaf >> 1)]), (leaf >> 1, leaf & 1))])
              for t, r in enumerate(right) for leaf in range(4)}
    assert len(set(found)) == 8 and [chance[f] for f in found] == sorted(chance.values(), reverse=True)


def test_leaves_and_visits_of_any_size_meet_in_bounded_blocks(spark, monkeypatch):
    """A sample far smaller than the table, queries whose ids share a divisor: parts and blocks keep their bounds, the answers stay."""
    rng = np.random.default_rng(8)
    rows = spark.createDataFrame([(20 * k, [float(a) for a in v], 0) for k, v in enumerate(rng.normal(size=(900, 8)).astype(np.float32))], SCHEMA)
    monkeypatch.setattr(rp_forest, "SAMPLE", 32)
    whole = table_of(rp_forest.nearest(rows, k=5))
    monkeypatch.setattr(rp_forest, "PART_VALUES", 8 * 50)
    seen = []
    plain = rp_forest.meetings
    monkeypatch.setattr(rp_forest, "meetings", lambda *a: seen.append(plain(*a)) or seen[-1])
    assert table_of(rp_forest.nearest(rows, k=5)) == whole

    sizes = seen[0].where("query_id is null").groupBy("tree", "leaf", "part").count().collect()
    assert max(r["count"] for r in sizes) < 100 and sum(r["count"] for r in sizes) == rp_forest.TREES * 900
    blocks = []
    plain_compared = rp_forest.compared
    monkeypatch.setattr(rp_forest, "compared", lambda q, own, floor, x, *a: blocks.append((len(q), len(x))) or plain_compared(q, own, floor, x, *a))
    batches = seen[0].coalesce(1).sortWithinPartitions("tree", "leaf", "part", "query_id").toArrow().to_batches(max_chunksize=64)
    best = {}
    for most, scores in ((8192, 1 << 20), (7, 1 << 20), (8192, 300)):
        blocks.clear()
        found = [r for b in rp_forest.met(iter(batches), "<f4", 5, False, most, scores) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert all(n <= most and (n == 1 or n * size <= scores) for n, size in blocks)
        best[most, scores] = sorted(found)
    assert len({tuple((q, c) for q, c, _ in found) for found in best.values()}) == 1


def test_each_length_is_searched_by_itself(spark, monkeypatch):
    """Vectors of other lengths are no candidates, and have queries of their own."""
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=(3, 3, 3, 5, 8)[k % 5]).astype(np.float32).tolist(), 1) for k in range(120)]
    got = rp_forest.nearest(spark.createDataFrame(rows, SCHEMA), k=4, every=2).collect()
    length = {key: len(v) for key, v, _ in rows}
    assert all(length[r["query_id"]] == length[r["vec_id"]] for r in got)
    for size in (3, 5, 8):
        want = brute([r for r in rows if len(r[1]) == size], 4, 2)
        assert compare([r for r in got if length[r["query_id"]] == size], want) > 0.9
    monkeypatch.setattr(rp_forest, "MAX_LENGTHS", 2)
    with pytest.raises(ValueError, match="more than 2 lengths"):
        rp_forest.nearest(spark.createDataFrame(rows, SCHEMA))


def test_ids_of_a_vector_that_many_rows_hold(spark):
    rows = spark.range(5000).selectExpr("id AS vec_id", "cast(if(id % 3 = 0, 'hot', cast(id AS string)) AS binary) AS vec")
    found = {bytes(r["vec"]): r["ids"] for r in rp_forest.classes_of(rows, 4).collect()}
    assert found[b"hot"] == [0, 3, 6, 9, 12] and len(found) == 1 + 3333
