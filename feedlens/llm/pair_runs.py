"""Sorted runs of pair-document records, compressed by zstd, and their k-way merge.

A pair is a key: side A's id times WIDTH plus side B's, so ascending keys are ordered by A first. A run holds, for ascending
keys, the number of documents of each and those documents (their number within a block, ascending) with the links of each.
Columns are stored as byte planes of 32-bit numbers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import zstandard

#: Ids of side B lie below this; keys stay below 2 ** 63 for any A id below 2 ** 47.
WIDTH = 1 << 16


def pack(columns: Sequence[np.ndarray], level: int = 1) -> bytes:
    """Columns of non-negative numbers below 2 ** 32, each as four byte planes, in one zstd frame."""
    planes = [np.ascontiguousarray(c.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=level).compress(b"".join(planes))


def unpack(data: bytes, sizes: Sequence[int]) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    columns, at = [], 0
    for n in sizes:
        columns.append(np.ascontiguousarray(raw[at:at + 4 * n].reshape(4, n).T).view("<u4").ravel())
        at += 4 * n
    return columns


def pack_keys(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys (as differences, 64 bits in two columns) and a 64-bit count each."""
    steps = np.diff(keys, prepend=0).astype(np.uint64)
    counts = counts.astype(np.uint64)
    low, high = np.uint64(0xFFFFFFFF), np.uint64(32)
    return pack([steps & low, steps >> high, counts & low, counts >> high])


def unpack_keys(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, d = (column.astype(np.int64) for column in unpack(data, [n] * 4))
    return np.cumsum(a + (b << 32)), c + (d << 32)


def by_side(keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of a run, (A id, B ids, counts) for ascending A."""
    side = keys // WIDTH
    starts = np.flatnonzero(np.diff(side, prepend=-1))
    for a, lo, hi in zip(side[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)]):
        yield a, keys[lo:hi] % WIDTH, counts[lo:hi]


def merge(runs: Sequence[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all runs (packed keys and their number) with summed counts, by a k-way heap merge.

    The heap holds the next A id of every run; an A id's counts are summed in one array over side B, so what is held beside the
    result doesn't grow with the number of runs.
    """
    streams = [by_side(*unpack_keys(data, n)) for data, n in runs]
    heap = []
    for k, stream in enumerate(streams):
        head = next(stream, None)
        if head is not None:
            heapq.heappush(heap, (head[0], k, head[1], head[2]))
    keys, counts = [], []
    total = np.zeros(WIDTH, dtype=np.int64)
    while heap:
        a = heap[0][0]
        seen = []
        while heap and heap[0][0] == a:
            _, k, b, c = heap[0]
            total[b] += c
            seen.append(b)
            head = next(streams[k], None)
            if head is None:
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (head[0], k, head[1], head[2]))
        b = seen[0] if len(seen) == 1 else np.unique(np.concatenate(seen))
        keys.append(a * WIDTH + b)
        counts.append(total[b])
        total[b] = 0
    if not keys:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(keys), np.concatenate(counts)


def side_maxima(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each key, whether its count is the highest of its A id (ties included); keys ascend and hold whole A ids."""
    if not len(keys):
        return np.empty(0, dtype=bool)
    starts = np.flatnonzero(np.diff(keys // WIDTH, prepend=-1))
    most = np.maximum.reduceat(counts, starts)
    return counts == np.repeat(most, np.diff(np.append(starts, len(keys))))
