"""Operator 9: hierarchical multi-length packing of tokenised documents.

Each document's ids (and one end id) are cut into full windows of the longest tier; the rest
is routed to the shortest tier that holds it. Every tier packs its own windows, gaps of
long windows are filled from shorter tiers (cutting a piece where none fits), and windows
of equal length are dealt into step groups of equal token budget.
A task packs its own input split in bounded flushes; nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import map_rows
from .tokens import groups, word_encoder

#: Longest window; shorter tiers are its halves.
WINDOW = 2048
#: The id that ends a document.
END_ID = 1
#: Tokens waiting in a task before its tiers are packed.
FLUSH_TOKENS = 1 << 20
#: Tokens of a step group: so many windows of a tier as hold this many tokens.
STEP_TOKENS = 1 << 15
#: Text encoded together by a task.
GROUP_CHARS = 1 << 20

SCHEMA = ("{id} bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, window_length int, step_group bigint")


class Packer:
    """Packs one task's documents. A segment is (doc, ids, start in its document, document's tokens)."""

    def __init__(self, task: int, window: int = WINDOW, flush_tokens: int = FLUSH_TOKENS):
        if window < 1 or window & (window - 1):
            raise ValueError("the window must be a power of two")
        self.window, self.flush_tokens = window, flush_tokens
        self.base = task << 36
        self.sequences = 0
        self.windows_of: dict[int, int] = defaultdict(int)
        self.tiers = [window >> k for k in range(window.bit_length())]
        self.pools: dict[int, deque] = {tier: deque() for tier in self.tiers}
        self.waiting = 0

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        total, at = len(ids), 0
        while total - at >= self.window:
            yield from self.close([(doc, ids[at:at + self.window], at, total)], self.window)
            at += self.window
        if at < total:
            self.route((doc, ids[at:], at, total))
            self.waiting += total - at
            if self.waiting >= self.flush_tokens:
                yield from self.flush()

    def route(self, segment: tuple) -> None:
        size = len(segment[1])
        self.pools[1 << (size - 1).bit_length()].append(segment)

    def take(self, gap: int, below: int) -> tuple | None:
        """The next segment for a gap: whole from the longest tier that fits, else one cut to the gap."""
        for tier in self.tiers:
            if tier <= gap and tier <= below and self.pools[tier]:
                return self.pools[tier].popleft()
        for tier in reversed(self.tiers):
            if tier <= below and self.pools[tier]:
                doc, ids, start, total = self.pools[tier].popleft()
                if len(ids) > gap:
                    self.route((doc, ids[gap:], start + gap, total))
                return doc, ids[:gap], start, total
        return None

    def flush(self, last: bool = False) -> Iterator[tuple]:
        """Pack the tiers, longest first; an unfilled window waits for the next flush, or is split at the end."""
        open_segments: list[tuple] = []
        for tier in self.tiers:
            while self.pools[tier]:
                used, inside = 0, []
                while used < tier:
                    segment = self.take(tier - used, tier)
                    if segment is None:
                        break
                    inside.append(segment)
                    used += len(segment[1])
                if used == tier:
                    yield from self.close(inside, tier)
                else:
                    open_segments += inside
        self.waiting = sum(len(s[1]) for s in open_segments)
        if last:
            yield from self.split(open_segments)
        else:
            for segment in open_segments:
                self.route(segment)

    def split(self, segments: list[tuple]) -> Iterator[tuple]:
        """The task's last tokens, fewer than a few windows, as windows of falling powers of two: no padding."""
        queue, left = deque(segments), sum(len(s[1]) for s in segments)
        while left:
            size = min(self.window, 1 << (left.bit_length() - 1))
            inside, used = [], 0
            while used < size:
                doc, ids, start, total = queue.popleft()
                gap = size - used
                if len(ids) > gap:
                    queue.appendleft((doc, ids[gap:], start + gap, total))
                    ids = ids[:gap]
                inside.append((doc, ids, start, total))
                used += len(ids)
            yield from self.close(inside, size)
            left -= size

    def close(self, inside: list[tuple], size: int) -> Iterator[tuple]:
        sequence = self.base + self.sequences
        self.sequences += 1
        step = self.base + (size.bit_length() << 30) + self.windows_of[size] // max(1, STEP_TOKENS // size)
        self.windows_of[size] += 1
        offset = 0
        for doc, ids, start, total in inside:
            yield (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total,
                   sequence, offset, size, step)
            offset += len(ids)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, flush_tokens: int = FLUSH_TOKENS) -> DataFrame:
    """One row per piece of a document, with its place in a sequence.

    Sequences have exactly ``window`` tokens or a smaller power of two, so none is padded. Null and
    empty texts are the end id alone. Repeated rows are packed each on its own; a null id
    stays null. Other columns are ignored; an empty table gives no rows.
    """
    schema = SCHEMA.format(id=f"`{id_col}`")

    def run(rows):
        context = TaskContext.get()
        packer = Packer(context.partitionId() if context else 0, window, flush_tokens)
        encoder = word_encoder(tokenizer_path)
        for group in groups(rows, lambda r: len(r[1] or ""), GROUP_CHARS):
            for (doc, _), ids in zip(group, encoder.encode([text or "" for _, text in group])):
                yield from packer.add(doc, np.append(ids, np.uint32(END_ID)))
        yield from packer.flush(last=True)

    return map_rows(docs.select(id_col, text_col), run, schema)
