"""Operator 2: near-duplicate groups by a MinHash LSH forest, every link confirmed on full shingle sets.

Documents of equal shingle sets form a class. A class's 64 MinHash values are put into ``ORDERS`` different orders (the trees). In
each tree, classes that share the first ``DEPTH`` values form a region, sorted by the values that follow. Candidates come from the
trees in two rounds:

1. neighbours: in each sorted order the next class, which shares the longest common prefix. A dense region is searched deeper: its rows
   are parted by as many further bits of the order as its size asks for, by all of them where
   that isn't enough, and dealt only where they are all the same. The pairs that meet in most orders and with
   the longest prefix are confirmed, and components merged;
2. the rest, without loss: in every region that still holds several components, the signatures of each row outside the largest
   one are compared with those of all rows of other components. Classes joined by plausible pairs, over all trees, form a cluster, to which each
   whole set is sent once, and whose sets are compared in turn. Regions and clusters are dealt into units of bounded size, in which every
   row meets every other; a task keeps a union of what it has joined and reports one pair a merge, so no
   list of pairs is ever made. Regions and clusters too dense for that are searched through an exact
   prefix filter: groups of members that share one of their rarest shingles, by exact counts.

Two texts at the threshold share no region with a probability of about 1.3e-5; nothing is capped after that (signatures of
such a pair agree in fewer than ``AGREE`` values with a probability below 1e-5).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, compact, cut, map_rows, out_batches, records, ship
from .components import components

#: Words of a shingle; a link needs 100 * intersection >= SHARE * union.
WORDS, SHARE = 5, 75
VALUES, ORDERS, DEPTH = 64, 32, 3
#: Further values of the order in a row's sort key, a byte each (a long).
DEEPER = 8
#: Rows sorted together in a dense region.
CHUNK = 512
#: Neighbours of a class confirmed in the first round.
NEAREST = 2
#: Rows, and shingles, of a side of a unit that compares signatures, and whole sets.
UNIT_ROWS, UNIT_SHINGLES = 1024, 1 << 19
#: Units in a row of a region or cluster above which the prefix filter takes over.
DENSE = 16
#: Classes (24 bytes each) whose texts are found by a broadcast; more are joined by a shuffle of the texts.
BROADCAST_ROWS = 500_000
#: Signature values that plausible partners share.
AGREE = 32

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_RNG = np.random.default_rng(20)
_MULTIPLIERS = _RNG.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _RNG.integers(0, 2**63, VALUES, dtype=np.uint64)
_TREES = np.array([_RNG.permutation(VALUES) for _ in range(ORDERS)])
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 2**64) for k in range(WORDS)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words met in a task; emptied when large."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > self.LIMIT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct shingle hashes of a text: A-Z lowered, words between ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(h) < WORDS:
        return mix((h * _POWERS[:len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    n = len(h) - WORDS + 1
    out = h[:n] * _POWERS[0]
    for k in range(1, WORDS):
        out = out + h[k:k + n] * _POWERS[k]
    return np.unique(mix(out))


def signature(found: np.ndarray) -> np.ndarray:
    """64 MinHash values of 32 bits; the set is read in parts so that long texts need little memory."""
    out = np.full(VALUES, 2**32 - 1, dtype=np.uint64)
    for at in range(0, len(found), 4096):
        values = found[at:at + 4096, None] * _MULTIPLIERS[None, :] + _ADDENDS[None, :]
        np.minimum(out, (values >> np.uint64(32)).min(axis=0), out=out)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        import xxhash

        hashes = WordHashes()
        for doc, text, text_key in rows:
            found = shingles(text, hashes)
            if len(found):
                yield doc, text_key, len(found), xxhash.xxh128_digest(found.tobytes()), signature(found).astype("<u4").tobytes()
            else:
                yield doc, text_key, 0, None, None

    return map_rows(docs, run, "doc_id bigint, text_key bigint, n_shingles bigint, set_key binary, signature binary")


def regions(reps: DataFrame) -> DataFrame:
    """A row for each class and tree: region (the tree and its order's first values) and key (further values)."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for rep, n, sig in rows:
            values = np.frombuffer(sig, dtype="<u4").astype(np.uint64)[_TREES]
            head = np.arange(ORDERS, dtype=np.uint64)
            for k in range(DEPTH):
                head = mix(head * _MIX[0] + values[:, k])
            deeper = (mix(values[:, DEPTH:DEPTH + DEEPER]) & np.uint64(255)).astype(np.uint8)
            keys = np.ascontiguousarray(deeper).view(">i8")[:, 0]
            for region, key in zip(head.astype(np.int64).tolist(), keys.tolist()):
                yield region, key, rep, n

    return map_rows(reps, run, "region bigint, key bigint, rep bigint, n bigint")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Whole shingle sets of the wanted classes (rep, doc_id, text_key), each from one text that has it."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        hashes = WordHashes()
        for rep, text in rows:
            yield rep, shingles(text, hashes).astype(np.int64).tolist()

    texts = docs.join(wanted, ["doc_id", "text_key"]).select("rep", "text").dropDuplicates(["rep"])
    return map_rows(texts, run, "rep bigint, shingles array<bigint>")


def alike(n: str, m: str) -> Column:
    """Sizes that allow a link."""
    return 100 * F.least(n, m) >= SHARE * F.greatest(n, m)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    joined = pairs.select("a", "b").join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b").select(
        "a", "b", (F.size("left") + F.size("right")).alias("all"), F.size(F.array_intersect("left", "right")).alias("both"))
    return joined.where(100 * F.col("both") >= SHARE * (F.col("all") - F.col("both"))).select("a", "b")


def merged(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes (rep, component) after the components joined by links (a, b between classes) become one."""
    edges = (links.join(nodes.toDF("a", "x"), "a").join(nodes.toDF("b", "y"), "b")
             .where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")))
    found = components(edges).toDF("component", "least")
    return compact(nodes.join(found, "component", "left").select("rep", F.coalesce("least", "component").alias("component")))[0]


def ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def deepened(active: DataFrame) -> DataFrame:
    """The rows with ``prefix``, ``rest`` and ``deal``: what beside its region a row's sorted order is parted by, at the depth its region needs."""
    bits = F.when(F.col("size") <= CHUNK, 0).otherwise(F.least(F.lit(63), F.ceil(F.log2(F.col("size") / CHUNK)))).cast("int")
    rows = active.withColumn("prefix", F.expr("0L")).withColumn("bits", bits)
    rows = rows.withColumn("prefix", F.when(F.col("bits") > 0, F.expr("shiftrightunsigned(key, 64 - bits)")).otherwise(0))
    first = rows.where("bits > 0").groupBy("region", "prefix").agg(F.count("*").alias("there")).where(F.col("there") > CHUNK)
    rows = rows.join(first, ["region", "prefix"], "left").withColumn("rest", F.when(F.col("there").isNotNull(), F.col("key")))
    second = (rows.where("rest is not null").groupBy("region", "rest").agg(F.count("*").alias("same")).where(F.col("same") > CHUNK))
    return (rows.join(second, ["region", "rest"], "left")
            .withColumn("deal", F.when(F.col("same").isNotNull(), F.pmod(F.xxhash64("rep"), F.ceil(F.col("same") / CHUNK))))
            .select("region", "key", "rep", "n", "prefix", "rest", "deal"))


def neighbours(active: DataFrame) -> DataFrame:
    """Round 1: each row's next one in sorted order; of each class the pairs that meet in most orders, then with the longest common prefix."""
    order = Window.partitionBy("region", "prefix", "rest", "deal").orderBy("key", "rep")
    following = deepened(active).withColumns({c: F.lead(c[5:]).over(order) for c in ("next_rep", "next_n", "next_key")})
    differ = F.col("key").bitwiseXOR(F.col("next_key"))
    prefix = sum(F.when(F.shiftrightunsigned(differ, 8 * k) == 0, 1).otherwise(0) for k in range(DEEPER))
    pairs = (following.where(F.col("next_rep").isNotNull() & alike("n", "next_n"))
             .groupBy(*ordered("rep", "next_rep")).agg(F.count("*").alias("count"), F.max(prefix).alias("prefix")))
    best = lambda one: Window.partitionBy(one).orderBy(F.desc("count"), F.desc("prefix"), "a", "b")
    ends = pairs.select("a", "b", "count", "prefix", F.explode(F.array("a", "b")).alias("end"))
    return ends.withColumn("rank", F.row_number().over(best("end"))).where(F.col("rank") <= NEAREST).select("a", "b").distinct()


def divided(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows (grp, rep, n) of the groups that hold several components, with their component, and of the group: its largest component, its rows
    and shingles (``total``, ``total_n``) and those outside the largest component (``outside``, ``outside_n``)."""
    rows = rows.select("grp", "rep", "n").join(nodes, "rep")
    sizes = rows.groupBy("grp", "component").agg(F.count("*").alias("own"), F.sum("n").alias("own_n"))
    whole = (sizes.groupBy("grp").agg(F.max(F.struct("own", "component", "own_n")).alias("top"), F.sum("own").alias("total"),
                                      F.sum("own_n").alias("total_n"), F.count("*").alias("parts"))
             .where("parts > 1").select("grp", F.col("top.component").alias("largest"), "total", "total_n",
                                        (F.col("total") - F.col("top.own")).alias("outside"),
                                        (F.col("total_n") - F.col("top.own_n")).alias("outside_n")))
    return compact(rows.join(whole, "grp"))[0]


def units(split: DataFrame, parts: Column, left_parts: Column) -> DataFrame:
    """The rows of each unit: of its group a part of the rows outside the largest component (``left``), and a part of all rows. Every left row
    meets every other row of its group in one unit."""
    part, left_part = F.pmod(F.xxhash64("rep"), parts), F.pmod(F.xxhash64("rep"), left_parts)
    keep = ["grp", "rep", "n", "component"]
    right = split.select(*keep, F.lit(False).alias("left"), F.explode(F.sequence(F.lit(0), left_parts - 1)).alias("i"), part.alias("j"))
    left = (split.where("component <> largest")
            .select(*keep, F.lit(True).alias("left"), left_part.alias("i"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("j")))
    return left.unionByName(right).select(F.xxhash64("grp", "i", "j").alias("unit"), "left", "rep", "n", "component")


def by_unit(rows: DataFrame, function, schema: str) -> DataFrame:
    """``function`` of the rows of each unit, which a task gets sorted by unit; it yields tuples."""
    fields = arrow_schema(schema)
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            unit, held = None, []
            for row in records(batches):
                if row[0] != unit:
                    if held:
                        yield from function(held)
                    unit, held = row[0], []
                held.append(row)
            if held:
                yield from function(held)

        yield from out_batches(found(), fields)

    return rows.repartition("unit").sortWithinPartitions("unit", "left", "rep").mapInArrow(run, schema)


def plausible(held: list[tuple]) -> Iterator[tuple]:
    """Pairs of a unit's rows (left and other side) that may be linked by their sizes and signatures; one for each merge of what they join."""
    left = np.array([row[1] for row in held])
    rep = np.array([row[2] for row in held], dtype=np.int64)
    n = np.array([row[3] for row in held], dtype=np.int64)
    component = np.array([row[4] for row in held], dtype=np.int64)
    signs = np.frombuffer(b"".join(row[5] for row in held), dtype="<u4").reshape(len(held), VALUES)
    label = np.unique(rep, return_inverse=True)[1]  # a row may stand on both sides
    a, b = np.flatnonzero(left), np.flatnonzero(~left)
    for at in range(0, len(a), 256):
        part = a[at:at + 256]
        small, large = np.minimum(n[part, None], n[b]), np.maximum(n[part, None], n[b])
        may = (component[part, None] != component[b]) & (100 * small >= SHARE * large)
        if not may.any():
            continue
        same = np.zeros(may.shape, dtype=np.uint8)
        for k in range(VALUES):
            same += signs[part, None, k] == signs[b, k]
        may &= same >= AGREE
        for x, row in zip(part.tolist(), may):
            others = b[np.flatnonzero(row)]
            others = others[label[others] != label[x]]
            if len(others):
                joined, first = np.unique(label[others], return_index=True)
                for y in others[first].tolist():
                    yield int(rep[x]), int(rep[y])
                label[np.isin(label, joined)] = label[x]


def linking(held: list[tuple]) -> Iterator[tuple]:
    """Links between a unit's left rows and its others on whole sets, one for each merge of two components."""
    root: dict[int, int] = {}

    def top(c: int) -> int:
        while root.get(c, c) != c:
            root[c] = root.get(root[c], root[c])
            c = root[c]
        return c

    lefts, others = [row for row in held if row[1]], [row for row in held if not row[1]]
    if not lefts or not others:
        return
    sizes = np.array([row[3] for row in others], dtype=np.int64)
    values = np.concatenate([np.asarray(row[5], dtype=np.int64) for row in others])
    owners = np.repeat(np.arange(len(others)), sizes)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    for _, _, rep, n, component, data in lefts:
        own = top(component)
        open_ = np.array([top(row[4]) != own for row in others])
        if not open_.any():
            continue
        mine = np.asarray(data, dtype=np.int64)
        first, last = np.searchsorted(values, mine, side="left"), np.searchsorted(values, mine, side="right")
        count = last - first
        at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        both = np.bincount(owners[at], minlength=len(others))
        for k in np.flatnonzero(open_ & (100 * both >= SHARE * (n + sizes - both))).tolist():
            x, y = top(component), top(others[k][4])
            if x != y:
                root[max(x, y)] = min(x, y)
                yield rep, others[k][2]


def clusters(split: DataFrame, signatures: DataFrame) -> DataFrame:
    """(grp, rep, n): the classes that plausible pairs of the regions join, by cluster."""
    parts, left_parts = (F.ceil(F.col(c) / UNIT_ROWS) for c in ("total", "outside"))
    rows = units(split, parts, left_parts).join(signatures, "rep").select("unit", "left", "rep", "n", "component", "signature")
    found = components(compact(by_unit(rows, plausible, "a bigint, b bigint").distinct())[0])
    return found.toDF("rep", "grp").join(split.select("rep", "n").distinct(), "rep")


def linked(split: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join the components of each group."""
    parts, left_parts = (F.ceil(F.col(c) / UNIT_SHINGLES) for c in ("total_n", "outside_n"))
    rows = units(split, parts, left_parts).join(sets, "rep").select("unit", "left", "rep", "n", "component", "shingles")
    return by_unit(rows, linking, "a bigint, b bigint")


def by_rare_shingles(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Groups (grp, rep, n) of members that share one of their rarest shingles.

    Two sets of a similarity t share at least t * n elements with the larger set's n; so in any common order
    they share one among each one's first n - ceil(t * n) + 1. The order is from rare to frequent, by counts over all
    members, so a passage that very many texts share leads no group unless they are near copies. Shingles of one member
    lead nowhere and are left out.
    """
    held = members.select("rep", "n").distinct().join(sets, "rep").select("rep", "n", F.explode("shingles").alias("shingle"))
    often = held.groupBy("shingle").agg(F.count("*").alias("often"))
    in_order = (held.join(often, "shingle").groupBy("rep", "n")
                .agg(F.array_sort(F.collect_list(F.struct("often", "shingle"))).alias("all")))
    first = F.col("n") - F.ceil(F.col("n") * SHARE / 100) + 1
    rare = F.explode(F.slice("all", F.lit(1), first.cast("int"))).alias("one")
    return in_order.select("rep", "n", rare).where("one.often > 1").select(F.xxhash64("one.shingle", F.lit(1)).alias("grp"), "rep", "n")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row.

    component_id is the smallest id reachable over links, the row's own included; kept is true where they are
    equal. Rows of one id are one document, whatever their texts: a link of any of them links the id. Null, empty and blank
    texts have no shingles and stay alone. Rows with a null id stay alone, with a null component, and are kept. Other
    columns are ignored; an empty table gives no rows.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
    sketch = cut(sketches(docs))
    classes = cut(sketch.where("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_key")).alias("one"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
        .select(F.monotonically_increasing_id().alias("rep"), "set_key", "one.doc_id", "one.text_key", "n", "signature"))
    rows = regions(classes.select("rep", "n", "signature"))
    sizes = rows.groupBy("region").agg(F.count("*").alias("size")).where("size > 1")
    active, _ = compact(rows.join(sizes, "region"))
    wanted = active.select("rep").distinct()
    asked, n = compact(classes.join(wanted, "rep", "left_semi").select("rep", "doc_id", "text_key"))
    # so few that every task can have them leave the texts where they lie
    sets = cut(sets_of(docs, F.broadcast(asked) if n <= BROADCAST_ROWS else asked))

    links, _ = compact(confirmed(neighbours(active), sets))
    nodes = merged(classes.select("rep", F.col("rep").alias("component")), links.unionByName(same_ids(sketch, classes)))
    split = divided(active.select(F.col("region").alias("grp"), "rep", "n"), nodes)
    wide = F.col("total") > DENSE * UNIT_ROWS
    groups = divided(clusters(split.where(~wide), classes.select("rep", "signature")), nodes)
    heavy = F.col("total_n") > DENSE * UNIT_SHINGLES
    dense = split.where(wide).select("rep", "n").unionByName(groups.where(heavy).select("rep", "n")).distinct()
    nodes = merged(nodes, linked(groups.where(~heavy), sets))
    if not dense.isEmpty():
        nodes = merged(nodes, linked(divided(compact(by_rare_shingles(dense, sets))[0], nodes), sets))

    named = classes.join(nodes, "rep").select("set_key", "component", "doc_id")
    least = named.groupBy("component").agg(F.min("doc_id").alias("group"))
    return sketch.join(named.join(least, "component").select("set_key", "group"), "set_key", "left").select(
        F.col("doc_id").alias(id_col), "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("group", "doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def same_ids(sketch: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of ids that have several texts."""
    held = sketch.where("set_key is not null and doc_id is not null").select("doc_id", "set_key").join(
        classes.select("set_key", "rep"), "set_key").select("doc_id", "rep")
    several = held.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last").select("doc_id", "a")
    return held.join(several, "doc_id").select("a", F.col("rep").alias("b")).where("a <> b").distinct()
