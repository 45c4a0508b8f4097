"""Operator 6: main text of pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. A word scores by the elements around its block, a tag costs; both weights are
learned from labelled pages, the first by logistic regression. One linear scan finds the contiguous
region of the highest total score. Blocks inside the region whose words score below zero (an
advert amid an article) are left out of the text.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows
from .html_blocks import Block, blocks_of
from .labelled_pages import pages

#: Labelled pages, passes of the regression, its penalty.
PAGES, PASSES, PENALTY = 1500, 400, 1e-5
#: A word's score: its log-odds of being content, within these bounds.
LEAST, MOST = -0.25, 1.0


@dataclass
class Weights:
    words: dict[str, float]
    bias: float
    tags: dict[str, float]
    other_tag: float

    def word(self, block: Block) -> float:
        return min(MOST, max(LEAST, self.bias + sum(self.words.get(f, 0.0) for f in block.features)))


def learn(labelled: list[str]) -> Weights:
    """Weights from pages whose content words are x."""
    blocks = [b for p in labelled for b in blocks_of(p)]
    seen = Counter((b.features, b.text[0] == "x") for b in blocks)
    kinds = sorted({f for f, _ in seen}, key=sorted)  # blocks of equal surroundings count together
    names = sorted({f for kind in kinds for f in kind})
    x = np.array([[f in kind for f in names] for kind in kinds], dtype=np.float64)
    yes, no = (np.array([seen[kind, label] for kind in kinds], dtype=np.float64) for label in (True, False))
    w, bias, m, v = np.zeros(len(names)), 0.0, np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, PASSES + 1):
        error = ((yes + no) / (1 + np.exp(-(x @ w + bias))) - yes) / len(blocks)
        g = np.append(x.T @ error + PENALTY * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    inside, outside = Counter(), Counter()
    for block in blocks:
        (inside if block.text[0] == "x" else outside).update(block.tags)
    n_in, n_out = max(1, sum(inside.values())), max(1, sum(outside.values()))
    odds = {t: float(np.log((inside[t] + 1) / n_in) - np.log((outside[t] + 1) / n_out)) for t in inside | outside}
    cost = {t: min(-0.02, 0.02 * o) for t, o in odds.items()}
    return Weights(dict(zip(names, w.tolist())), float(bias), cost, -0.02)


def region(scores: list[float]) -> tuple[int, int]:
    """First and end index of the contiguous part with the largest positive sum (the earlier of equal ones); (0, 0) if none is positive."""
    best, where, total, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, where = total, (start, k + 1)
    return where


def main_text(page: str, weights: Weights) -> str:
    blocks = blocks_of(page)
    words = [weights.word(b) for b in blocks]
    scores: list[float] = []
    for block, word in zip(blocks, words):  # the tags before a block, then its words
        scores += [sum(weights.tags.get(t, weights.other_tag) for t in block.tags), word * block.words]
    first, end = region(scores)
    return "\n\n".join(b.text for k, (b, word) in enumerate(zip(blocks, words)) if first <= 2 * k + 1 < end and word > 0)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of each page; null, empty and textless pages give an empty text.

    Repeated rows, null ids and null urls stay rows; other columns are ignored.
    """
    weights = learn(pages(PAGES))

    def run(rows):
        for page_id, url, page in rows:
            text = main_text(page or "", weights)
            yield page_id, url, text, len(text)

    return map_rows(df.select(id_col, url_col, html_col), run,
                    f"`{id_col}` bigint, `{url_col}` string, text string, n_chars bigint")
