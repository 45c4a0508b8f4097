"""Operator 4: byte-level BPE by recursive queries, one in-memory DuckDB per Python worker.

Encoding: a task's distinct new pieces become token-position rows. A recursive query joins each
adjacent pair to the merge table, contracts every word's leftmost pair of minimum rank, and goes on
with the words that changed until none does. Pieces that are tokens themselves skip the merges. The
recursion takes a step for each merge of the longest piece, so pieces of more than ``LONG_PIECE`` bytes (texts without
spaces) are contracted in the same order by a heap of their pairs instead, in n log n steps.
Decoding: token-position rows join the vocabulary; an ordered aggregation puts the bytes together.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_rows
from .tokens import Known, groups, read_ranks

#: Pieces kept in a worker's memory; when there are more, the first half, which holds the frequent ones, stays (a memory
#: bound; results don't depend on it).
CACHE_PIECES = 400_000
#: Bytes of a piece above which the heap contracts it.
LONG_PIECE = 512
#: Bytes of new pieces contracted by one recursive query, and tokens decoded by one: memory bounds only.
QUERY_BYTES = 4 << 20
DECODE_TOKENS = 1 << 20
#: Bytes of text encoded together.
GROUP_BYTES = 8 << 20

#: Every way to split a token in two tokens, with the ids of the three.
MERGE_TABLE = """
create table merges as
select l.id as l, r.id as r, s.id as m
from (select id, h, unnest(range(2, length(h), 2)) as cut from vocab) s
join vocab l on l.h = left(s.h, s.cut)
join vocab r on r.h = substr(s.h, s.cut + 1)
"""

#: word, position (dense from 0), token, the next position's token (-1: none). The pair's right row becomes the merged
#: token and moves one left, its left row goes, the row before learns its new neighbour.
CONTRACT = """
with recursive state as (
    select word, pos, tok, nxt, false as final from pieces
    union all
    (with live as (select word, pos, tok, nxt from state where not final),
          best as (select word, min((m::bigint << 32) + pos) as k
                   from live join merges on tok = l and nxt = r group by word),
          step as (select live.*, (k >> 32)::int as m, (k & 4294967295)::int as hit
                   from live left join best using (word))
     select word,
            case when hit is not null and pos > hit then pos - 1 else pos end,
            case when pos = hit + 1 then m else tok end,
            case when pos = hit - 1 then m else nxt end,
            hit is null
     from step where hit is null or pos <> hit)
)
select word, pos, tok from state where final
"""

DECODE = """
select doc, string_agg(c, '' order by pos) as c
from tokens join vocab on tok = id group by doc
"""


class Bpe:
    """Vocabulary, merge table and known pieces of one worker."""

    def __init__(self, ranks_path: str, pattern: str):
        import duckdb
        import regex

        self.ranks = read_ranks(ranks_path)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.known = Known()
        self.written = [str(i) for i in range(max(self.ranks.values()) + 1)]
        self.pairs: dict[tuple[int, int], int] = {}
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})
        # tokens as hexadecimal text, to be cut; and with a character for each byte, to be joined
        self.db.register("given", pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "h": [token.hex() for token in self.ranks],
                                            "c": [token.decode("latin-1") for token in self.ranks]}))
        self.run("create table vocab as select * from given")
        self.run(MERGE_TABLE)

    def run(self, sql: str) -> pa.Table | None:
        got = self.db.sql(sql)
        return None if got is None else got.to_arrow_table()

    def contract(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (int32) of pieces that are no tokens themselves."""
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        tok = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        nxt = np.append(tok[1:], np.int32(-1))
        nxt[starts + sizes - 1] = -1
        self.db.register("pieces", pa.table({
            "word": np.repeat(np.arange(len(pieces), dtype=np.int32), sizes),
            "pos": (np.arange(len(tok)) - np.repeat(starts, sizes)).astype(np.int32), "tok": tok, "nxt": nxt.astype(np.int32)}))
        got = self.run(CONTRACT)
        self.db.unregister("pieces")
        word = got["word"].to_numpy()
        counts = np.bincount(word, minlength=len(pieces))
        ends = np.cumsum(counts)
        ids = np.empty(len(word), dtype=np.int32)
        ids[(ends - counts)[word] + got["pos"].to_numpy()] = got["tok"].to_numpy()  # positions are dense from 0 again
        data, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def contract_long(self, data: bytes) -> list[int]:
        """Ids of one long piece: a heap of its pairs by rank, then place, over a linked list of tokens."""
        if not self.pairs:
            table = self.run("select l, r, m from merges")
            self.pairs = dict(zip(zip(table["l"].to_pylist(), table["r"].to_pylist()), table["m"].to_pylist()))
        tok = self.byte_ids[np.frombuffer(data, dtype=np.uint8)].tolist()
        end = len(tok)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(m, k) for k in range(end - 1) if (m := self.pairs.get((tok[k], tok[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, k = heapq.heappop(heap)
            right = after[k]
            if right == end or tok[k] < 0 or self.pairs.get((tok[k], tok[right])) != m:
                continue
            tok[k], tok[right] = m, -1
            after[k] = after[right]
            if after[k] < end:
                before[after[k]] = k
                if (new := self.pairs.get((m, tok[after[k]]))) is not None:
                    heapq.heappush(heap, (new, k))
            if before[k] >= 0 and (new := self.pairs.get((tok[before[k]], m))) is not None:
                heapq.heappush(heap, (new, before[k]))
        return [t for t in tok if t >= 0]

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of pieces."""
        found: dict[str, bytes] = {}
        held: list[tuple[str, bytes]] = []
        weight = 0

        def merge() -> None:
            if held:
                found.update(zip((piece for piece, _ in held), self.contract([data for _, data in held])))

        for piece in pieces:
            data = piece.encode()
            if (rank := self.ranks.get(data)) is not None:
                found[piece] = array("i", [rank]).tobytes()
            elif len(data) > LONG_PIECE:
                found[piece] = array("i", self.contract_long(data)).tobytes()
            else:
                if weight + len(data) > QUERY_BYTES:
                    merge()
                    held, weight = [], 0
                held.append((piece, data))
                weight += len(data)
        merge()
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (int32) of each text."""
        found = [self.known.find(self.pattern.findall(text)) for text in texts]
        if self.known.missed:
            fresh = self.learn(list(dict.fromkeys(self.known.missed)))
            self.known.fill(fresh)
            self.known.update((piece, ids) for piece, ids in fresh.items() if len(piece) <= LONG_PIECE)
            self.known.keep_half(CACHE_PIECES)
        return [np.frombuffer(b"".join(ids), dtype=np.int32) for ids in found]

    def decode(self, sequences: list[np.ndarray]) -> list[bytes]:
        """Bytes of id sequences; long ones are decoded in parts and joined."""
        parts: list[list[bytes]] = [[] for _ in sequences]
        held: list[tuple[int, np.ndarray]] = []
        weight = 0
        for k, ids in enumerate(sequences):
            for at in range(0, len(ids), DECODE_TOKENS):
                piece = ids[at:at + DECODE_TOKENS]
                if weight + len(piece) > DECODE_TOKENS:
                    self._decode(held, parts)
                    held, weight = [], 0
                held.append((k, piece))
                weight += len(piece)
        self._decode(held, parts)
        return [b"".join(p) for p in parts]

    def _decode(self, held: list[tuple[int, np.ndarray]], parts: list[list[bytes]]) -> None:
        if not held:
            return
        sizes = [len(ids) for _, ids in held]
        total = sum(sizes)
        self.db.register("tokens", pa.table({
            "doc": np.repeat(np.arange(len(held), dtype=np.int32), sizes), "pos": np.arange(total, dtype=np.int32),
            "tok": np.concatenate([ids for _, ids in held]).astype(np.int32)}))
        got = self.run(DECODE)
        self.db.unregister("tokens")
        found = dict(zip(got["doc"].to_pylist(), got["c"].to_pylist()))
        for n, (k, _) in enumerate(held):
            parts[k].append(found[n].encode("latin-1"))


@lru_cache(maxsize=2)
def worker_bpe(ranks_path: str, pattern: str) -> Bpe:
    return Bpe(ranks_path, pattern)


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids array<int>) of every whole text, as the rank file's encoder gives without special tokens.

    Null and empty texts have no tokens. Repeated rows and null ids stay rows; other columns are ignored.
    """
    def run(rows):
        bpe = worker_bpe(ranks_path, pattern)
        for group in groups(rows, lambda r: len(r[1] or ""), GROUP_BYTES):
            for (doc, _), ids in zip(group, bpe.encode([text or "" for _, text in group])):
                yield doc, ids.tolist()

    return map_rows(df.select(id_col, text_col), run, f"`{id_col}` bigint, token_ids array<int>")


def decode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, decoded binary) of rows with token_ids; null or no ids give no bytes."""
    def run(rows):
        bpe = worker_bpe(ranks_path, pattern)
        for group in groups(rows, lambda r: len(r[1] or ()), DECODE_TOKENS):
            sequences = [np.array(ids or [], dtype=np.int32) for _, ids in group]
            for (doc, _), data in zip(group, bpe.decode(sequences)):
                yield doc, data

    return map_rows(df.select(id_col, "token_ids"), run, f"`{id_col}` bigint, decoded binary")


def round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode its ids, in one pass: token count and digests of ids and bytes."""
    def run(rows):
        bpe = worker_bpe(ranks_path, pattern)
        for group in groups(rows, lambda r: len(r[1] or ""), GROUP_BYTES):
            encoded = bpe.encode([text or "" for _, text in group])
            decoded = bpe.decode(encoded)
            for (doc, _), ids, data in zip(group, encoded, decoded):
                yield (doc, len(ids), hashlib.sha256(",".join(map(bpe.written.__getitem__, ids.tolist())).encode()).hexdigest(),
                       hashlib.sha256(data).hexdigest())

    return map_rows(df.select(id_col, text_col), run,
                    f"`{id_col}` bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
