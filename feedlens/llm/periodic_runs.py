"""Operator 11: stretches of words that repeat with a period (maximal repetitions).

The words of many documents are joined, a unique separator before, between and after them, and one run-length grammar is made
by recompression (``recompression.Grammar``). A run of period q and length 2q at least
holds two neighbouring multiples of q (counted in its document), so every run is found from the harmonic grid of such pairs: for
each pair with the same word, the grammar tells how far period q extends to both sides. No suffix array is made.
A run found with several multiples of its period keeps the smallest.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows
from .recompression import BACKWARD, FORWARD, Grammar
from .tokens import groups

MIN_LENGTH = 12
#: Words of documents handled together in one grammar; a longer document is handled by itself.
GROUP_WORDS = 150_000
#: Extension queries answered at once, and grid pairs looked at together (memory bounds).
QUERIES_AT_ONCE = 500_000
#: Words of the grid that is kept ready; longer documents' grids go on in stretches of this many.
GRID_WORDS = 1 << 15
SCHEMA = ("{id} bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
          "runs_sha256 string, collapsed_sha256 string")


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's input: for one id in ten, by CRC32 of the decimal id, words from one place on repeat a stretch. A null id changes nothing."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * ((n - a) // p + 1))[:n - a]


def grid(lo: int, hi: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiples j of every period q up to n / 2 that lie in [lo, hi), by j; each stands for the pair (j - q, j)."""
    q = np.arange(1, min(n // 2, hi - 1) + 1)
    at = np.maximum(-(-lo // q), 1)
    count = np.maximum((hi - 1) // q - at + 1, 0)
    period = np.repeat(q, count)
    nth = np.arange(len(period)) - np.repeat(np.cumsum(count) - count, count)
    j = (np.repeat(at, count) + nth) * period
    order = np.argsort(j, kind="stable")
    return j[order], period[order]


@lru_cache(maxsize=1)
def ready_grid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grid of GRID_WORDS words, and where each j begins in it: a shorter document's grid is a prefix."""
    j, q = grid(1, GRID_WORDS, 2 * GRID_WORDS)
    return j.astype(np.int32), q.astype(np.int32), np.searchsorted(j, np.arange(GRID_WORDS + 1))


def candidates(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid pairs (their later word and period) of a document whose two words are the same."""
    n = len(words)
    j, q, begins = ready_grid()
    end = begins[min(n, GRID_WORDS)]
    j, q = j[:end], q[:end]
    hit = np.flatnonzero(words[j] == words[j - q])
    hit = hit[q[hit] <= n // 2]
    yield j[hit].astype(np.int64), q[hit].astype(np.int64)
    for lo in range(GRID_WORDS, n, GRID_WORDS):
        j, q = grid(lo, min(lo + GRID_WORDS, n), n)
        hit = words[j] == words[j - q]
        yield j[hit], q[hit]


def runs_of(docs: list[np.ndarray], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """Of each document (words as numbers from 0 on) its runs: rows (start, length, period) by start, then period.

    A run is a stretch with smallest period q and at least max(min_length, 2q) words that no word beside it extends.
    """
    separator = max((int(d.max()) for d in docs if len(d)), default=-1) + 1
    marks = np.arange(separator, separator + len(docs) + 1)
    base = np.cumsum([1] + [len(d) + 1 for d in docs])
    text = np.concatenate([marks[:1]] + [part for d, mark in zip(docs, marks[1:]) for part in (d, [mark])])
    grammar = Grammar(text)
    found: list[np.ndarray] = []
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    weight = 0

    def answer() -> None:
        nonlocal weight
        which, later, period = (np.concatenate(column) for column in zip(*held))
        held.clear()
        weight = 0
        for at in range(0, len(later), QUERIES_AT_ONCE):
            part = slice(at, at + QUERIES_AT_ONCE)
            j, q = later[part], period[part]
            ahead = grammar.extensions(j - q, j, FORWARD)
            back = grammar.extensions(j - q, j, BACKWARD) - 1
            length = ahead + back + q
            # a run is reported by its first grid pair alone
            good = (back < q) & (length >= np.maximum(min_length, 2 * q))
            start = j - q - back
            found.append(np.stack([which[part], start, length, q], axis=1)[good])

    for k, words in enumerate(docs):
        if len(words) < max(min_length, 2):
            continue
        for j, q in candidates(words):
            held.append((np.full(len(j), k), j + base[k], q))
            weight += len(j)
            if weight >= QUERIES_AT_ONCE:
                answer()
    if held:
        answer()
    rows = np.concatenate(found) if found else np.empty((0, 4), dtype=np.int64)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    same = (rows[1:, :3] == rows[:-1, :3]).all(axis=1)
    rows = rows[np.concatenate(([True], ~same))[:len(rows)]]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    bounds = np.searchsorted(rows[:, 0], np.arange(len(docs) + 1))
    return [rows[a:b, 1:] - [base[k], 0, 0] for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay when every run is cut to its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def numbered(documents: list[list[bytes]]) -> list[np.ndarray]:
    """The words of documents as numbers, equal for equal words."""
    names: dict[bytes, int] = {}
    return [np.fromiter((names.setdefault(w, len(names)) for w in words), dtype=np.int64, count=len(words))
            for words in documents]


def _digest(parts: str | bytes) -> str:
    return hashlib.sha256(parts.encode() if isinstance(parts, str) else parts).hexdigest()


def row_of(doc_id: int | None, words: list[bytes], runs: np.ndarray) -> tuple:
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs.tolist())
    collapsed = words
    if len(runs):
        collapsed = [words[k] for k in np.flatnonzero(kept_words(len(words), runs)).tolist()]
        best = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]))
        best = (*best, 1000 * best[1] // best[2])
    else:
        best = (None,) * 4
    return (doc_id, len(runs), *best, _digest(listed), _digest(b" ".join(collapsed)))


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_length: int = MIN_LENGTH, plant: bool = True) -> DataFrame:
    """Periodic runs of each text's words (maximal stretches without space, tab, LF, VT, FF, CR).

    Returns one row per input row: n_runs; start, length, period and exponent_milli of the longest run (ties: smallest start,
    then period; four nulls without a run); SHA-256 of the run list and of the text with every run cut to its first period.
    plant: texts of one id in ten get a repeated tail first (``repeated_tail``). Null and empty texts have no words and no runs; null
    ids and repeated rows stay rows; other columns are ignored. No shuffle: a task handles its own rows in groups of bounded size.
    """

    def run(rows):
        split = ((doc, repeated_tail(words, doc) if plant else words)
                 for doc, words in ((doc, (text or "").encode().split()) for doc, text in rows))
        for group in groups(split, lambda row: len(row[1]) + 1, GROUP_WORDS):
            for (doc, words), runs in zip(group, runs_of(numbered([words for _, words in group]), min_length)):
                yield row_of(doc, words, runs)

    return map_rows(df.select(id_col, text_col), run, SCHEMA.format(id=f"`{id_col}`"))
