"""Operator 5: nearest neighbours by largest inner product, from a forest of random-projection trees.

Vectors get one more component that makes their lengths equal, so that a larger inner product with a query is a
smaller angle. Each tree splits at medians of random projections of a bounded sample; every row is
indexed in every tree. A query walks all trees at once through one priority queue, ordered by
the probability that a neighbour as near as those found so far lies below a node, until the visited
leaves hold such a neighbour with probability ``TARGET``. Close neighbours take few leaves; the queue
goes on for queries whose neighbours are hardly nearer than chance, and nothing caps it.

A leaf's rows are dealt into parts of bounded size, however large the table is beside the sample. Each visit
goes to all parts of its leaf; a task holds the vectors of one part and lets its visits pass in blocks.

Equal vectors are indexed once, with as many of their smallest ids as an answer can need.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import cut, map_rows, sample, ship

NEIGHBOURS, QUERY_EVERY = 20, 20
TREES, LEAF_ROWS = 4, 400
#: Distinct vectors that place the splits, at most; they also bound the number of leaves.
SAMPLE, SAMPLE_PER_LEAF = 32768, 16
#: Leaves of the first walk, the angle it assumes, and the probability at which the second one stops.
FIRST_LEAVES, FIRST_COSINE, TARGET = 6, 0.8, 0.95
#: Queries that meet a leaf part at once, numbers in a part's vectors, and scores computed at once, at most.
QUERY_CHUNK, PART_VALUES, BLOCK_SCORES = 8192, 1 << 21, 1 << 20
#: Lengths of vectors in one column.
MAX_LENGTHS = 16


@dataclass
class Forest:
    """directions [trees, nodes, d + 1] and thresholds [trees, nodes], nodes in heap order; norm: the longest vector's."""

    directions: np.ndarray
    thresholds: np.ndarray
    depth: int
    norm: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors of length 1 whose inner products with queries keep their order."""
        rest = np.sqrt(np.maximum(0, self.norm**2 - (vectors**2).sum(axis=1)))
        return np.concatenate([vectors, rest[:, None]], axis=1) / self.norm

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree: [trees, rows]."""
        x = self.lifted(vectors)
        out = np.zeros((len(self.directions), len(x)), dtype=np.int64)
        for t in range(len(self.directions)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                side = np.einsum("nd,nd->n", x, self.directions[t][node]) > self.thresholds[t][node]
                node = 2 * node + 1 + side
            out[t] = node - (2**self.depth - 1)
        return out

    def right_probability(self, queries: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        """[trees, queries, nodes]: that a neighbour at the given cosine to its query lies right of each split."""
        q = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        q /= np.linalg.norm(q, axis=1, keepdims=True)
        along = np.matmul(q, self.directions.transpose(0, 2, 1))
        c = np.clip(cosine, -0.999999, 0.999999)[None, :, None]
        spread = np.sqrt((1 - c**2) * np.maximum(1e-12, 1 - along**2) / (q.shape[1] - 1))
        z = (c * along - self.thresholds[:, None, :]) / spread
        return 0.5 * (1 + np.tanh(math.sqrt(2 / math.pi) * (z + 0.044715 * z**3)))


def grow(sample: np.ndarray, rows: int, norm: float, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 3) -> Forest:
    """Trees for so many rows, with splits at the sample's medians."""
    rng = np.random.default_rng(seed)
    most = max(0, int(math.log2(max(1, len(sample) / SAMPLE_PER_LEAF))))
    depth = min(most, max(0, math.ceil(math.log2(max(1, rows / leaf_rows)))))
    forest = Forest(np.zeros((trees, 0, 0)), np.zeros((trees, 0)), depth, norm)
    x = forest.lifted(sample)
    forest.directions = rng.normal(size=(trees, 2**depth - 1, x.shape[1]))
    forest.directions /= np.linalg.norm(forest.directions, axis=2, keepdims=True)
    forest.thresholds = np.zeros((trees, 2**depth - 1))
    for t in range(trees):
        inside = {0: np.arange(len(x))}
        for node in range(2**depth - 1):
            rows_ = inside.pop(node)
            p = x[rows_] @ forest.directions[t, node]
            forest.thresholds[t, node] = cut_at = float(np.median(p)) if len(p) else 0.0
            inside[2 * node + 1], inside[2 * node + 2] = rows_[p <= cut_at], rows_[p > cut_at]
    return forest


def walk(right: list[list[float]], depth: int, leaves: int | None, target: float) -> list[tuple[int, int]]:
    """The (tree, leaf) pairs of one query, from a queue shared by all trees; right: [tree][node].

    Stops after so many leaves, or where some tree holds the neighbour in a visited leaf with the target
    probability (trees count as independent).
    """
    first = 2**depth - 1
    queue = [(-1.0, t, 0) for t in range(len(right))]
    missing = [1.0] * len(right)
    found: list[tuple[int, int]] = []
    while queue:
        chance, t, node = heapq.heappop(queue)
        while node < first:
            p = right[t][node]
            near, far, keep = (2 * node + 2, 2 * node + 1, p) if p >= 0.5 else (2 * node + 1, 2 * node + 2, 1 - p)
            heapq.heappush(queue, (chance * (1 - keep), t, far))
            chance, node = chance * keep, near
            if queue[0][0] < chance:
                chance, t, node = heapq.heapreplace(queue, (chance, t, node))
        found.append((t, node - first))
        missing[t] = max(0.0, missing[t] + chance)
        if leaves is not None and len(found) >= leaves or leaves is None and math.prod(missing) <= 1 - target:
            break
    return found


def vectors_of(df: DataFrame, id_col: str, vector_col: str, kind: str) -> DataFrame:
    """(vec_id, size, vec): the usable vectors' bytes, one a row id (of repeated ids, the smallest by bytes)."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, values in rows:
            if key is None or not values or None in values:
                continue
            v = np.array(values, dtype=kind) + 0
            if np.isfinite(v).all() and v.any():
                yield key, len(v), v.tobytes()

    return map_rows(df.select(id_col, vector_col), run, "vec_id bigint, size int, vec binary").groupBy("vec_id").agg(
        F.min(F.struct("size", "vec")).alias("v")).select("vec_id", "v.size", "v.vec")


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """(class, vec, ids): each distinct vector with its k + 1 smallest ids; Spark keeps so many of a vector in each task before the shuffle."""
    place = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    least = rows.select("vec", "vec_id", place.alias("place")).where(F.col("place") <= k + 1)
    ids = least.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return ids.select(F.col("ids")[0].alias("class"), "vec", "ids")


def matrix(column, kind: str) -> np.ndarray:
    """Vectors' bytes as rows of doubles."""
    return np.frombuffer(b"".join(column), dtype=kind).reshape(len(column), -1).astype(np.float64)


def probes(queries: DataFrame, forest: Forest, kind: str, second: bool) -> DataFrame:
    """(tree, leaf, query_id, class, vec, floor) for the leaves that each query visits."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for query, own, vec, floor in rows:
            q = matrix([vec], kind)
            cosine = floor / (float(np.linalg.norm(q)) * forest.norm) if second else FIRST_COSINE
            right = [r[0].tolist() for r in forest.right_probability(q, np.array([cosine]))]
            for t, leaf in walk(right, forest.depth, None if second else FIRST_LEAVES, TARGET):
                yield t, leaf, query, own, vec, floor

    return map_rows(queries, run, "tree int, leaf bigint, query_id bigint, class bigint, vec binary, floor double")


def parts_of(index: DataFrame, rows: int) -> DataFrame:
    """(tree, leaf, parts): the parts of about so many rows, at most, into which each leaf's rows are dealt."""
    return index.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / rows).cast("int").alias("parts"))


def meetings(index: DataFrame, visits: DataFrame, parts: DataFrame) -> DataFrame:
    """Index rows (with a null query_id) and visits side by side, sorted so that a leaf part's index rows come before its visits."""
    keys = ["tree", "leaf", "part"]
    each = F.broadcast(parts)
    stored = index.join(each, ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int").alias("part"),
        F.lit(None).cast("bigint").alias("query_id"), "class", "vec", F.lit(0.0).alias("floor"))
    asked = visits.join(each, ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "query_id", "class", "vec", "floor")
    return stored.unionByName(asked).repartition(*keys).sortWithinPartitions(*keys, "query_id")


def compared(q: np.ndarray, own: np.ndarray, floor: np.ndarray, x: np.ndarray, names: np.ndarray, k: int,
             second: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of a block of queries i and vectors j: the k best of each query, or in the second walk all not below its floor."""
    rough = q @ x.T
    rough[own[:, None] == names[None, :]] = -np.inf
    if second:
        near = rough >= floor[:, None] - 1e-9 * (1 + np.abs(rough, where=np.isfinite(rough), out=np.zeros_like(rough)))
        i, j = np.nonzero(near)
    else:
        best = np.argpartition(-rough, min(k, rough.shape[1]) - 1, axis=1)[:, :k]
        i, j = np.repeat(np.arange(len(q)), best.shape[1]), best.ravel()
        keep = np.isfinite(rough[i, j])
        i, j = i[keep], j[keep]
    scores = [(q[i[a:a + 4096]] * x[j[a:a + 4096]]).sum(axis=1) for a in range(0, len(i), 4096)]
    return i, j, np.concatenate(scores) if scores else np.zeros(0)


def met(batches: Iterator[pa.RecordBatch], kind: str, k: int, second: bool, most: int = QUERY_CHUNK,
        scores: int = BLOCK_SCORES) -> Iterator[pa.RecordBatch]:
    """(query_id, class, score) from the sorted rows of ``meetings``; one leaf part's vectors are held, its visits pass in blocks."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)])
        query, own, vec = batch.column(3), batch.column(4).to_numpy(), batch.column(5)
        floor = batch.column(6).to_numpy()
        stored = query.is_null().to_numpy(zero_copy_only=False)
        new = (keys[:, 1:] != keys[:, :-1]).any(axis=0) | (stored[1:] != stored[:-1])
        starts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            if key != (here := tuple(keys[:, a].tolist())):
                key, held = here, []
            if stored[a]:
                held.append((matrix(vec.slice(a, b - a).to_pylist(), kind), own[a:b]))
                continue
            if not held:
                continue
            if len(held) > 1:
                held = [tuple(map(np.concatenate, zip(*held)))]
            x, names = held[0]
            step = min(most, max(1, scores // len(x)))
            for at in range(a, b, step):
                n = min(step, b - at)
                q = matrix(vec.slice(at, n).to_pylist(), kind)
                i, j, score = compared(q, own[at:at + n], floor[at:at + n], x, names, k, second)
                if len(i):
                    ids = query.slice(at, n).to_numpy(zero_copy_only=False).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(names[j]), pa.array(score)], ["query_id", "class", "score"])


def scored(index: DataFrame, visits: DataFrame, parts: DataFrame, kind: str, k: int, second: bool) -> DataFrame:
    """(query_id, class, score) from visited leaves: the k best of each part, or in the second walk all not below the floor."""
    return (meetings(index, visits, parts)
            .mapInArrow(lambda batches: met(batches, kind, k, second), "query_id bigint, class bigint, score double")
            .groupBy("query_id", "class").agg(F.max("score").alias("score")))


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS,
            every: int = QUERY_EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row whose id is divisible by ``every``.

    Candidates are all rows but the query's own; ties go to the smaller id. Rows with a null id, and vectors that are null,
    empty, zero or hold a null or non-finite component take no part. Vectors of different lengths have no inner product: each length is
    searched by itself (more than ``MAX_LENGTHS`` are an error). Rows that repeat an id count once. Other columns are ignored.
    """
    spark = df.sparkSession
    ship(spark)
    kind = "<f4" if isinstance(df.schema[vector_col].dataType, ArrayType) and isinstance(
        df.schema[vector_col].dataType.elementType, FloatType) else "<f8"
    rows = cut(vectors_of(df, id_col, vector_col, kind))
    sizes = sorted(r["size"] for r in rows.select("size").distinct().limit(MAX_LENGTHS + 1).collect())
    if len(sizes) > MAX_LENGTHS:
        raise ValueError(f"vectors of more than {MAX_LENGTHS} lengths")
    found = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    for size in sizes:
        found = found.unionByName(nearest_of(rows.where(F.col("size") == size).drop("size"), size, kind, k, every))
    return found


def nearest_of(rows: DataFrame, size: int, kind: str, k: int, every: int) -> DataFrame:
    """``nearest`` of vectors (vec_id, vec) of one length."""
    classes = cut(classes_of(rows, k))
    drawn = sample(classes.select("vec"), F.xxhash64("vec"), SAMPLE).collect()
    drawn = matrix(sorted(r["vec"] for r in drawn), kind)
    squares = map_rows(classes.select("vec"), lambda r: ((float((matrix([v], kind) ** 2).sum()),) for v, in r), "s double")
    n, longest = squares.agg(F.count("*"), F.max("s")).first()
    forest = grow(drawn, n, math.sqrt(longest) * (1 + 1e-12))

    asked = rows.where(F.col("vec_id") % every == 0)
    queries = cut(asked.join(classes.select("class", "vec"), "vec").select(
        F.col("vec_id").alias("query_id"), "class", "vec", F.lit(0.0).alias("floor")))

    def indexed(batch: Iterator[tuple]) -> Iterator[tuple]:
        for name, vec in batch:
            for t, leaf in enumerate(forest.leaves(matrix([vec], kind))[:, 0].tolist()):
                yield t, leaf, name, vec

    index = cut(map_rows(classes.select("class", "vec"), indexed, "tree int, leaf bigint, class bigint, vec binary"))
    parts = cut(parts_of(index, max(1, PART_VALUES // size)))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "class")
    first = scored(index, probes(queries, forest, kind, False), parts, kind, k, False)
    floors = (first.withColumn("place", F.row_number().over(best)).where(F.col("place") == k)
              .select("query_id", F.col("score").alias("found")))
    asked_again = queries.join(floors, "query_id", "left").select(
        "query_id", "class", "vec", F.coalesce("found", F.lit(-longest)).alias("floor"))
    second = scored(index, probes(asked_again, forest, kind, True), parts, kind, k, True)
    return answers(first.unionByName(second), queries, classes, kind, k)


def answers(found: DataFrame, queries: DataFrame, classes: DataFrame, kind: str, k: int) -> DataFrame:
    """Ranked row ids from scored distinct vectors, and from the query's own vector where other rows hold it too."""
    alone = map_rows(queries.select("query_id", "class", "vec"),
                     lambda rows: ((q, c, float((matrix([v], kind) ** 2).sum(axis=1)[0])) for q, c, v in rows),
                     "query_id bigint, class bigint, score double")
    held = found.unionByName(alone).groupBy("query_id", "class").agg(F.max("score").alias("score"))
    rows = (held.join(classes.select("class", "ids"), "class").select("query_id", "score", F.explode("ids").alias("vec_id"))
            .where("vec_id <> query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
