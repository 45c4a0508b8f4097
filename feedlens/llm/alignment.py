"""Operator 13: alignment of two tokenizers by external spill counting.

1. Every text is encoded by both; its groups and links follow from the byte offsets at which tokens end. A task sorts the
   links of a block of documents into pair-document records and radix-partitions them by a hash of the A id into
   sorted runs compressed by zstd (``pair_runs``), written as rows of a table in the shared folder.
2. The runs' keys and document counts of each radix partition are merged k ways by a heap, at most ``FAN_IN`` at once, in as many
   rounds as it takes. Keys ascend by A first, so the last merge also knows each A id's highest count.
3. The records of each radix partition, dealt in bounded chunks, stream past the merged counts. What they contribute to each
   document goes back in one packed row per block and partition, and a block's rows are summed with its documents.

A hot A id costs no task more than others: in 2 a run holds each of its pairs once, and in 3 its records are dealt by chunks.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import pair_runs
from .common import arrow_schema, fresh_folder, out_batches, records, ship
from .pair_runs import WIDTH
from .tokens import groups

#: Links and documents of one block, which is sorted in memory (a text with more links is a block by itself).
BLOCK_LINKS, BLOCK_DOCS = 3_000_000, 1 << 16
#: Bytes of text encoded at once.
BATCH_BYTES = 1 << 20
#: Records of one chunk; chunks that one task of step 3 meets on average; runs merged at once.
CHUNK_RECORDS, CHUNKS, FAN_IN = 1 << 18, 24, 128
#: Radix partitions: a power of two, one for so many bytes of text, within bounds.
PART_BYTES, LEAST_PARTS, MOST_PARTS = 32 << 20, 16, 2048

OUT = ("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
SPILL = ("kind int, block bigint, doc int, {id} bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
         "part int, chunk int, n_keys int, n_records int, keys binary, docs binary")
MERGED = "part int, run bigint, n_keys int, keys binary"


class Pair:
    """The two tokenizers, and the bytes and decimal strings of their ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.encode_a, self.bytes_a = byte_level_encoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        n_a, n_b = len(self.bytes_a), self.b.get_piece_size()
        if n_b > WIDTH:
            raise ValueError(f"side B has more than {WIDTH} ids")
        self.bytes_b = [self._piece_bytes(i) for i in range(n_b)]
        self.length_a = np.array([len(t) for t in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], dtype=np.int64)
        self.written = [[f"{i}{end}" for i in range(n)] for n in (n_a, n_b) for end in ",|"]
        self.written[3] = [f"{i};" for i in range(n_b)]

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Both sides' ids of each text; None where either side's bytes aren't those of a space and the text."""
        spaced = [" " + text for text in texts]
        side_a = self.encode_a(spaced)
        side_b = self.b.encode(texts, num_threads=1)
        out = []
        for text, a, b in zip(spaced, side_a, side_b):
            data = text.encode()
            same = (len(data) > 1 and b"".join(map(self.bytes_a.__getitem__, a)) == data
                    and b"".join(map(self.bytes_b.__getitem__, b)) == data)
            out.append((np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)) if same else None)
        return out

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[int, str, np.ndarray]:
        """Of one text's ids: the number of groups, their written form and the key of every link."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # every stretch between neighbouring ends of either side is the overlap of one A and one B token
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[np.diff(ends, prepend=0) > 0]
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        keys = a[at_a] * WIDTH + b[at_b]
        common = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
        last_a, last_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        last_a[at_a[common]], last_b[at_b[common]] = True, True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        n_groups = int(common.sum())
        # A's tokens of a group, then B's
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, side="left")
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
        parts = np.empty(len(a) + len(b), dtype=object)
        a_mid, a_last, b_mid, b_last = self.written
        parts[place_a] = [a_last[i] if end else a_mid[i] for i, end in zip(a.tolist(), last_a.tolist())]
        parts[place_b] = [b_last[i] if end else b_mid[i] for i, end in zip(b.tolist(), last_b.tolist())]
        return n_groups, "".join(parts.tolist())[:-1], keys


def byte_level_alphabet() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes stand for themselves, others from U+0100 on."""
    shown = {b: chr(b) for lo, hi in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(lo, hi + 1)}
    hidden = (b for b in range(256) if b not in shown)
    return shown | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


#: Fixed value: how byte-level tokenizers split a text before merging.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_level_encoder(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """How a byte-level ``tokenizers`` file encodes texts (special tokens' strings are ordinary text), and the bytes of its ids.

    A plain file, whose merges stand in the order of the ids that they make, is a table of ranks: its texts go to tiktoken,
    which gives the same ids several times faster. Any other file is left to the ``tokenizers`` library.
    """
    byte_of = {c: b for b, c in byte_level_alphabet().items()}
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    entries = {**model["vocab"], **special}
    tokens = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        tokens[i] = entry.encode() if entry in special else bytes(byte_of[c] for c in entry)
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    plain = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
             and not spec.get("normalizer") and made == list(range(256, 256 + len(made)))
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))
    if plain:
        import tiktoken

        ranks = {tokens[i]: i for entry, i in model["vocab"].items() if entry not in special}
        encoding = tiktoken.Encoding("side_a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: list(map(encoding.encode_ordinary, texts)), tokens
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return lambda texts: [found.ids for found in library.encode_batch_fast(texts, add_special_tokens=False)], tokens


@lru_cache(maxsize=1)
def tokenizer_pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def radix(a: np.ndarray, parts: int) -> np.ndarray:
    """The radix partition of A ids: the top bits of a multiplicative hash."""
    bits = parts.bit_length() - 1
    return ((a.astype(np.uint64) * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - bits)


def runs_of_block(keys: np.ndarray, docs: np.ndarray, parts: int) -> Iterator[tuple]:
    """The runs of one block of links (a key and a document number each) as (part, chunk, n_keys, n_records, keys, docs)."""
    both = np.sort(keys * BLOCK_DOCS + docs)
    starts = np.flatnonzero(np.diff(both, prepend=-1))
    links = np.diff(np.append(starts, len(both)))
    keys, docs = both[starts] // BLOCK_DOCS, both[starts] % BLOCK_DOCS
    part = radix(keys // WIDTH, parts)
    order = np.argsort(part, kind="stable")
    keys, docs, links, part = keys[order], docs[order], links[order], part[order]
    bounds = np.searchsorted(part, np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(bounds)).tolist():
        for chunk, lo in enumerate(range(bounds[p], bounds[p + 1], CHUNK_RECORDS)):
            hi = min(lo + CHUNK_RECORDS, bounds[p + 1])
            own = keys[lo:hi]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            held = np.diff(np.append(first, len(own)))
            step = np.diff(docs[lo:hi], prepend=0)
            step[first] = docs[lo:hi][first]  # a key's first document whole, then differences
            yield p, chunk, len(first), hi - lo, pair_runs.pack_keys(own[first], held), pair_runs.pack([step, links[lo:hi]])


def contributions(chunk: dict, keys: np.ndarray, counts: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a chunk's records add to each document of its block: (document number, links with their A id's highest count, summed counts of links).

    keys, counts, best: of the whole radix partition, ascending by key.
    """
    first, held = pair_runs.unpack_keys(chunk["keys"], chunk["n_keys"])
    step, links = (c.astype(np.int64) for c in pair_runs.unpack(chunk["docs"], [chunk["n_records"]] * 2))
    starts = np.cumsum(held) - held
    run = np.cumsum(step)
    docs = run - np.repeat(run[starts] - step[starts], held)
    at = np.searchsorted(keys, first)
    n_best, total = np.zeros(docs.max() + 1, dtype=np.int64), np.zeros(docs.max() + 1, dtype=np.int64)
    np.add.at(n_best, docs, links * np.repeat(best[at], held))
    np.add.at(total, docs, links * np.repeat(counts[at], held))
    present = np.flatnonzero(total)
    return present, n_best[present], total[present]


def spill(df: DataFrame, path_a: str, path_b: str, parts: int, id_col: str, text_col: str) -> DataFrame:
    """Step 1: a row for every document (kind 0) and for every chunk of a run (kind 1)."""
    fields = arrow_schema(SPILL.format(id=f"`{id_col}`"))
    ship(df.sparkSession)

    def encoded(batches) -> Iterator[tuple]:
        pair = tokenizer_pair(path_a, path_b)
        for group in groups(records(batches), lambda row: len(row[1] or "") + 64, BATCH_BYTES):
            full = [k for k, (_, text) in enumerate(group) if text]
            found = dict(zip(full, pair.encode([group[k][1] for k in full])))
            for k, (doc_id, _) in enumerate(group):
                yield doc_id, found.get(k)

    def rows(batches) -> Iterator[tuple]:
        pair = tokenizer_pair(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = []
        n_docs = n_links = 0

        def flush() -> Iterator[tuple]:
            if n_links:
                docs = np.repeat(np.arange(len(held)), [len(k) for k in held])
                for run in runs_of_block(np.concatenate(held), docs, parts):
                    yield (1, block, *(None,) * 7, *run)

        for doc_id, ids in encoded(batches):
            if ids is None:
                n_a = n_b = n_groups = 0
                digest, keys = "", np.empty(0, dtype=np.int64)
            else:
                n_a, n_b = map(len, ids)
                n_groups, written, keys = pair.align(*ids)
                digest = hashlib.sha256(written.encode()).hexdigest()
            if n_docs and (n_links + len(keys) > BLOCK_LINKS or n_docs == BLOCK_DOCS):
                yield from flush()
                held.clear()
                n_docs, n_links, block = 0, 0, block + 1
            yield (0, block, n_docs, doc_id, n_a, n_b, n_groups, len(keys), digest, *(None,) * 6)
            held.append(keys)
            n_docs, n_links = n_docs + 1, n_links + len(keys)
        yield from flush()

    def run(batches):
        yield from out_batches(rows(batches), fields)

    return df.select(id_col, text_col).mapInArrow(run, SPILL.format(id=f"`{id_col}`"))


def count(chunks: DataFrame, most_runs: int) -> DataFrame:
    """Step 2: the merged keys and counts of each radix partition, one row each, in rounds of about FAN_IN runs a merge."""
    fields = arrow_schema(MERGED)

    def merged(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys, counts = pair_runs.merge([(r["keys"], r["n_keys"]) for r in rows])
        return pa.Table.from_pylist([{"part": rows[0]["part"], "run": rows[0]["run"], "n_keys": len(keys),
                                      "keys": pair_runs.pack_keys(keys, counts)}], schema=fields)

    runs = chunks.select("part", F.xxhash64("block", "chunk").alias("run"), "n_keys", "keys")
    while True:
        most_runs = -(-most_runs // FAN_IN)
        runs = (runs.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(most_runs)))
                .groupBy("part", "run").applyInArrow(merged, MERGED))
        if most_runs <= 1:
            return runs


def contribute(chunks: DataFrame, counted: DataFrame, per_part: DataFrame) -> DataFrame:
    """Step 3: one row for every block and task with what its records add to the block's documents.

    per_part: the number of chunks of each radix partition (MOST_PARTS rows at most, so it may be broadcast). A partition's chunks are
    dealt over as many tasks as they need, and its counts, which the ids bound, go to each.
    """
    schema = "block bigint, n int, sums binary"
    fields = arrow_schema(schema)

    def run(dealt: pa.Table, merged: pa.Table) -> pa.Table:
        out = []
        if dealt.num_rows:
            (row,) = merged.to_pylist()
            keys, counts = pair_runs.unpack_keys(row["keys"], row["n_keys"])
            best = pair_runs.side_maxima(keys, counts)
            of_block: dict[int, list] = {}
            for batch in dealt.to_batches(max_chunksize=1):
                for chunk in batch.to_pylist():
                    of_block.setdefault(chunk["block"], []).append(contributions(chunk, keys, counts, best))
            for block, parts in of_block.items():
                docs, n_best, total = (np.concatenate(column) for column in zip(*parts))
                out.append({"block": block, "n": len(docs), "sums": pack_sums(docs, n_best, total)})
        return pa.Table.from_pylist(out, schema=fields)

    tasks = F.broadcast(per_part.select("part", F.ceil(F.col("chunks") / CHUNKS).cast("int").alias("tasks")))
    dealt = (chunks.join(tasks, "part").withColumn("task", F.pmod(F.xxhash64("block", "chunk"), F.col("tasks")).cast("int"))
             .select("part", "task", "block", "n_keys", "n_records", "keys", "docs"))
    copies = counted.join(tasks, "part").select("part", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), "n_keys", "keys")
    return dealt.groupBy("part", "task").cogroup(copies.groupBy("part", "task")).applyInArrow(run, schema)


def pack_sums(docs: np.ndarray, n_best: np.ndarray, total: np.ndarray) -> bytes:
    total = total.astype(np.uint64)
    return pair_runs.pack([docs, n_best, total & np.uint64(0xFFFFFFFF), total >> np.uint64(32)])


def unpack_sums(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs, n_best, low, high = (c.astype(np.int64) for c in pair_runs.unpack(data, [n] * 4))
    return docs, n_best, low + (high << 32)


def align(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How the tokens of two tokenizers line up in every text, and how common each link is in the whole table.

    path_a: a byte-level ``tokenizers`` file; path_b: a ``sentencepiece`` model that puts a space before a text. Texts are encoded
    whole, without special tokens. Null and empty texts, and texts whose tokens' bytes aren't a space and the text, have no
    tokens: zeros and an empty groups_sha256. Every row counts as one document, so repeated rows count repeatedly and null ids
    stay rows. Ties for an A id's highest count all count as highest. Other columns are ignored.
    """
    spark = df.sparkSession
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = LEAST_PARTS
    while parts < MOST_PARTS and parts * PART_BYTES < size:
        parts *= 2
    path = fresh_folder(spark, "alignment")
    spill(df, path_a, path_b, parts, id_col, text_col).write.parquet(path)
    spilled = spark.read.parquet(path)
    chunks = spilled.where("kind = 1")
    per_part = chunks.groupBy("part").agg(F.count(F.lit(1)).alias("chunks"))
    most = per_part.agg(F.max("chunks")).first()[0] or 0
    added = contribute(chunks, count(chunks, most), per_part)
    schema = f"`{id_col}` bigint, {OUT}"
    fields = arrow_schema(schema)

    def finish(docs: pa.Table, sums: pa.Table) -> pa.Table:
        n_best, total = np.zeros(docs.num_rows, dtype=np.int64), np.zeros(docs.num_rows, dtype=np.int64)
        for row in sums.to_pylist():
            which, more_best, more = unpack_sums(row["sums"], row["n"])
            np.add.at(n_best, which, more_best)
            np.add.at(total, which, more)
        at = docs.column("doc").to_numpy()
        made = {"n_best": pa.array(n_best[at]), "count_sum": pa.array(total[at])}
        return pa.Table.from_arrays([made.get(f.name, docs.column(k) if (k := docs.schema.get_field_index(f.name)) >= 0 else None)
                                     for f in fields], schema=fields)

    docs = spilled.where("kind = 0").select("block", "doc", id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return docs.groupBy("block").cogroup(added.groupBy("block")).applyInArrow(finish, schema)
