"""Tokenisation expressions (JVM-side, no Python in the row path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is a maximal run of Unicode letters.
WORD_PATTERN = r"\p{L}+"


def words(text) -> Column:
    """Lower-cased letter runs of ``text``; NULL text gives NULL."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit(WORD_PATTERN), 0)


def with_previous(words_col: Column) -> Column:
    """array<struct<w, prev>>: each word with the word before it (NULL first).

    ``words_col`` must be a column reference (not a tokenising expression):
    it is indexed once per element.
    """
    return F.transform(
        words_col,
        lambda w, i: F.struct(
            w.alias("w"),
            F.when(i > 0, F.element_at(words_col, i)).alias("prev")),
    )
