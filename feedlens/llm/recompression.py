"""A run-length grammar over numbered words, made by recompression, and its longest-common-extension queries.

Levels alternate between two steps. A block step replaces every maximal block of one repeated symbol by one symbol
named by (symbol, length). A pair step deals the symbols into a left and a right half by a hash and replaces each
adjacent left-right pair by one symbol. Both depend on symbols alone, so equal stretches are parsed alike up to their borders,
and a query follows two positions up and down the levels with one comparison a level. Levels are made when a query first needs them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FORWARD, BACKWARD = 1, -1


@dataclass
class Step:
    """How the symbols of one level make up those of the next."""

    is_block: bool
    parent: np.ndarray  # of each symbol
    first: np.ndarray  # its first child, of each symbol of the next level
    size: np.ndarray  # its number of children


def half(symbols: np.ndarray, salt: int) -> np.ndarray:
    """One hash bit of each symbol."""
    with np.errstate(over="ignore"):
        x = (symbols.astype(np.uint64) + np.uint64(salt + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40)) & np.uint64(1) == 1


class Grammar:
    """The grammar of a text whose first and last symbols, and any separators, occur once each."""

    def __init__(self, text: np.ndarray):
        self.levels = [np.ascontiguousarray(text, dtype=np.int64)]
        self.steps: list[Step] = []
        self._next_name = int(self.levels[0].max(initial=-1)) + 1
        self._salt = 0

    def step(self, level: int) -> Step:
        while len(self.steps) <= level:
            self._grow()
        return self.steps[level]

    def _grow(self) -> None:
        symbols = self.levels[-1]
        if len(self.steps) % 2 == 0:
            starts = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
            size = np.diff(np.append(starts, len(symbols)))
            made = np.flatnonzero(size > 1)
            second = size[made]
        else:
            left, right = self._halves(symbols)
            joined = left[:-1] & right[1:]
            starts = np.flatnonzero(np.concatenate(([True], ~joined)))
            size = np.diff(np.append(starts, len(symbols)))
            made = np.flatnonzero(size > 1)
            second = symbols[starts[made] + 1]
        above = symbols[starts]
        if len(made):
            above[made] = self._names(symbols[starts[made]], second)
        parent = np.repeat(np.arange(len(starts)), size)
        self.steps.append(Step(len(self.steps) % 2 == 0, parent, starts, size))
        self.levels.append(above)

    def _halves(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The halves that join more pairs of the two ways round; a level that joins none is left to the next salt."""
        self._salt += 1
        left = half(symbols, self._salt)
        ways = (left, ~left), (~left, left)
        return max(ways, key=lambda way: np.count_nonzero(way[0][:-1] & way[1][1:]))

    def _names(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """New symbols, equal for equal (a, b)."""
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        fresh = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        names = np.empty(len(a), dtype=np.int64)
        names[order] = self._next_name + np.cumsum(fresh) - 1
        self._next_name += int(fresh.sum())
        return names

    def extensions(self, i: np.ndarray, j: np.ndarray, direction: int) -> np.ndarray:
        """How many symbols from i and from j on (these included), in the direction, are the same; i and j differ pairwise."""
        u, v = i.astype(np.int64), j.astype(np.int64)
        stopped_at = np.zeros(len(u), dtype=np.int64)
        symbols = self.levels[0]
        live = np.flatnonzero(symbols[u] == symbols[v])
        level = 0
        while len(live):
            live = self._ascend(u, v, live, level, direction)
            level += 1
            stopped_at[live] = level
        for below in range(level - 1, -1, -1):
            self._descend(u, v, np.flatnonzero(stopped_at > below), below, direction)
        return (u - i) * direction

    def _ascend(self, u, v, live, level, direction) -> np.ndarray:
        """Move the live queries from a level to the next; those that meet a difference stay and are no longer live."""
        step, symbols = self.step(level), self.levels[level]
        p, q = u[live], v[live]
        left_p, left_q = self._left_in_parent(step, p, direction), self._left_in_parent(step, q, direction)
        inside = (left_p != step.size[step.parent[p]]) | (left_q != step.size[step.parent[q]])
        goes_on = ~inside | (symbols[p] == symbols[q])
        if step.is_block:
            ahead = np.where(inside & goes_on, np.minimum(left_p, left_q), 0)
            goes_on &= ~inside | (left_p == left_q)
        else:
            ahead = (inside & goes_on).astype(np.int64)
        p, q = p + ahead * direction, q + ahead * direction
        up = live[goes_on]
        u[live], v[live] = p, q
        u[up], v[up] = step.parent[p[goes_on]], step.parent[q[goes_on]]
        return up

    def _descend(self, u, v, live, level, direction) -> None:
        """Move queries that stand on two different symbols of the next level to the first two that differ on this one."""
        step, symbols = self.steps[level], self.levels[level]
        size_u, size_v = step.size[u[live]], step.size[v[live]]
        p, q = step.first[u[live]], step.first[v[live]]
        if direction == BACKWARD:
            p, q = p + size_u - 1, q + size_v - 1
        same = symbols[p] == symbols[q]
        ahead = np.where(same, np.minimum(size_u, size_v) if step.is_block else 1, 0)
        u[live], v[live] = p + ahead * direction, q + ahead * direction

    @staticmethod
    def _left_in_parent(step: Step, at: np.ndarray, direction: int) -> np.ndarray:
        """Children of the same parent from here on, this one included."""
        parent = step.parent[at]
        offset = at - step.first[parent]
        return step.size[parent] - offset if direction == FORWARD else offset + 1
