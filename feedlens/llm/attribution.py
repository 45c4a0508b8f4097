"""Operator 7: token counts by offset-mapped attribution.

A row's fields are joined into one document and encoded once. The tokens' byte spans are then
interval-joined (both sides sorted, one binary search for each token) to the spans of
the fields and of their sections, here lines. A token whose bytes lie in several sections
goes to one of them by an explicit rule:

* ``largest``: the section that holds most of its bytes, the earlier one in a tie;
* ``start``: the section that holds its first byte.

So the counts of a row's sections always add up to its tokens.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows
from .tokens import rank_encoder

RULES = ("largest", "start")
SCHEMA = ("{id} bigint, field string, section int, char_start bigint, char_end bigint, "
          "n_tokens bigint, n_crossing bigint, doc_tokens bigint")


def section_starts(data: np.ndarray, first: int, end: int) -> np.ndarray:
    """Byte offsets at which the lines of one field begin; a line break ends its line."""
    breaks = np.flatnonzero(data[first:end] == 10) + first + 1
    return np.concatenate(([first], breaks[breaks < end]))


def attribute(starts: np.ndarray, end: int, lengths: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and boundary-crossing tokens of each section.

    starts: of the sections, ascending from 0 (equal starts: empty sections, which get no
    token); end: of the last; lengths: of the tokens, in bytes.
    """
    stops = np.cumsum(lengths)
    begins = stops - lengths
    bounds = np.append(starts, end)
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, stops - 1, side="right") - 1
    owner = first.copy()
    crossing = np.flatnonzero(last > first)
    if rule == "largest":
        for k in crossing:
            inside = range(first[k], last[k] + 1)
            owner[k] = max(inside, key=lambda s: (min(stops[k], bounds[s + 1]) - max(begins[k], bounds[s]), -s))
    n = len(starts)
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def token_counts(df: DataFrame, ranks_path: str, pattern: str, fields: tuple[str, ...] = ("text",),
                 id_col: str = "doc_id", rule: str = "largest", separator: str = "\n\n") -> DataFrame:
    """Tokens of every section (line) of every field: one row per section, ``section`` counted within its field.

    char_start and char_end are offsets in the joined document; a separator belongs to the
    field before it. Null fields count as empty; an empty field has one section with no tokens of
    its own. Repeated rows and null ids stay rows; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    names = tuple(fields)

    def run(rows):
        encoding, token_bytes = rank_encoder(ranks_path, pattern)
        for doc, *values in rows:
            parts = [v or "" for v in values]
            parts = [p + separator for p in parts[:-1]] + parts[-1:]
            text = "".join(parts)
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            ids = np.array(encoding.encode_ordinary(text), dtype=np.int64)
            field_of, section_of, starts, at = [], [], [], 0
            for name, part in zip(names, parts):
                stop = at + len(part.encode())
                own = section_starts(data, at, stop)
                field_of += [name] * len(own)
                section_of += range(len(own))
                starts.append(own)
                at = stop
            bounds = np.concatenate([*starts, [at]])
            chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[bounds]
            counts, crossing = attribute(bounds[:-1], at, token_bytes[ids], rule)
            for k, (name, section) in enumerate(zip(field_of, section_of)):
                yield (doc, name, section, int(chars[k]), int(chars[k + 1]), int(counts[k]),
                       int(crossing[k]), len(ids))

    return map_rows(df.select(id_col, *names), run, SCHEMA.format(id=f"`{id_col}`"))
