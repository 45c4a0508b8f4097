"""Operator 3: language identification by a byte convolutional network, trained in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes. Bytes are embedded; filters of several widths run
over each window, are rectified and max-pooled, and a softmax gives the languages. A text's
prediction is the language with the highest mean log-probability over all its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, sample

WINDOW = 256
EMBED, WIDTHS, FILTERS = 6, (2, 3, 4), 12
#: Labelled documents that the network learns from, at most (by hash of the id), and its training.
TRAIN_DOCS, EPOCHS, BATCH, RATE = 6000, 14, 128, 0.01
#: Windows computed together.
BLOCK = 256
UNKNOWN = "und"
#: Score, and characters of text, from which on a prediction overrules a row's label.
SURE, SURE_CHARS = 0.7, 128


@dataclass
class Network:
    """embed [256, EMBED]; filters of all widths as one matrix over the longest (zero rows beyond a width); softmax."""

    labels: list[str]
    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """The embedded bytes under the longest filter at every position: [windows, positions, width * EMBED]."""
        n, size = windows.shape
        e = self.embed[windows].reshape(n, size * EMBED)
        span = max(WIDTHS) * EMBED
        view = np.lib.stride_tricks.sliding_window_view(e, span, axis=1)[:, ::EMBED]
        return view

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        columns = np.ascontiguousarray(self.columns(windows))
        n, positions, span = columns.shape
        found = (columns.reshape(-1, span) @ self.conv).reshape(n, positions, -1)
        return columns, found, found.max(axis=1) + self.bias

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = np.maximum(self.pooled(windows)[2], 0) @ self.out + self.out_bias
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def cut_windows(text: str) -> np.ndarray:
    """All bytes of a text, in lower case, in rows of ``WINDOW``, the last one filled up with zeros."""
    data = np.frombuffer(text.lower().encode(), dtype=np.uint8)
    rows = max(1, -(-len(data) // WINDOW))
    out = np.zeros(rows * WINDOW, dtype=np.uint8)
    out[:len(data)] = data
    return out.reshape(rows, WINDOW)


def train(texts: list[str], langs: list[str], seed: int = 5) -> Network | None:
    """Fit the network by Adam on one window a text; languages weigh equally. None without texts."""
    if not texts:
        return None
    rng = np.random.default_rng(seed)
    labels = sorted(set(langs))
    y = np.array([labels.index(v) for v in langs])
    x = np.concatenate([cut_windows(t)[:1] for t in texts])
    weight = (len(y) / np.maximum(np.bincount(y, minlength=len(labels)), 1) / len(labels))[y].astype(np.float32)
    span, filters = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((span * EMBED, filters), dtype=np.float32)
    for k, width in enumerate(WIDTHS):
        mask[:width * EMBED, k * FILTERS:(k + 1) * FILTERS] = 1
    normal = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    net = Network(labels, normal(256, EMBED) * 0.5, normal(span * EMBED, filters) * mask * 0.2,
                  np.zeros(filters, np.float32), normal(filters, len(labels)) * 0.1, np.zeros(len(labels), np.float32))
    names = ("embed", "conv", "bias", "out", "out_bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            grads = gradients(net, x[rows], y[rows], weight[rows], mask)
            step += 1
            rate = RATE * 0.5 ** (epoch / 5)
            for k in names:
                g = grads[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                setattr(net, k, (getattr(net, k) - rate * (first[k] / (1 - 0.9**step))
                                 / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32))
    return net


def gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray, mask: np.ndarray) -> dict:
    """Of the weighted cross-entropy; max pooling sends a filter's gradient to the position it was largest at."""
    columns, found, pooled = net.pooled(x)
    hidden = np.maximum(pooled, 0)
    z = hidden @ net.out + net.out_bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    p *= weight[:, None] / len(y)
    back = (p @ net.out.T) * (pooled > 0)
    at = found.argmax(axis=1)
    under = columns[np.arange(len(x))[:, None], at]  # [windows, filters, span * EMBED]
    into = (back[:, :, None] * net.conv.T[None]).reshape(len(x), -1, max(WIDTHS), EMBED)
    bytes_under = x[np.arange(len(x))[:, None, None], at[:, :, None] + np.arange(max(WIDTHS))]
    embed = np.zeros_like(net.embed)
    np.add.at(embed, bytes_under.ravel(), into.reshape(-1, EMBED))
    return {"embed": embed, "conv": np.einsum("nf,nfs->sf", back, under) * mask, "bias": back.sum(axis=0),
            "out": hidden.T @ p, "out_bias": p.sum(axis=0)}


def held_out(id_col: str):
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """A network from labelled documents that are not held out.

    At most ``TRAIN_DOCS`` documents, the first by a hash of their ids, each with one window of text from a
    place set by that hash. Rows with a null id, text or language teach nothing.
    """
    at = F.pmod(F.xxhash64(id_col), F.greatest(F.length(text_col) - WINDOW, F.lit(1))).cast("int") + 1
    labelled = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull()).select(
        F.xxhash64(id_col).alias("key"), F.substring(F.col(text_col), at, F.lit(WINDOW)).alias("text"),
        F.col(lang_col).alias("lang"), F.col(text_col).rlike(r"\p{L}").alias("letters"))
    rows = sample(labelled, F.col("key"), TRAIN_DOCS).where("letters").select("key", "text", "lang").collect()
    rows.sort()
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def letters():
    """A pattern that finds a letter of any script."""
    import regex

    return regex.compile(r"\p{L}")


def predictions(net: Network | None, rows: Iterator[tuple]) -> Iterator[tuple]:
    """(id, language, score) of texts, in blocks of windows across texts; score: geometric mean of the probabilities."""
    letter = letters()
    waiting: list[list] = []  # id, windows left, sum of log-probabilities, windows in all
    held: list[tuple[int, np.ndarray]] = []

    def compute() -> None:
        got = net.log_probabilities(np.concatenate([w for _, w in held]))
        at = 0
        for k, w in held:
            waiting[k][2] = waiting[k][2] + got[at:at + len(w)].sum(axis=0, dtype=np.float64)
            at += len(w)
        held.clear()

    def done() -> Iterator[tuple]:
        for doc, total, windows in ((w[0], w[2], w[3]) for w in waiting):
            if windows:
                mean = total / windows
                best = int(np.argmax(mean))
                yield doc, net.labels[best], float(np.exp(mean[best]))
            else:
                yield doc, UNKNOWN, 0.0
        waiting.clear()

    count = 0
    for doc, text in rows:
        if net is None or not text or not letter.search(text):
            waiting.append([doc, 0, 0.0, 0])
            continue
        windows = cut_windows(text)
        waiting.append([doc, 0, 0.0, len(windows)])
        for at in range(0, len(windows), BLOCK):
            part = windows[at:at + BLOCK]
            if count + len(part) > BLOCK:
                compute()
                count = 0
                if at == 0:
                    last = waiting.pop()
                    yield from done()
                    waiting.append(last)
            held.append((len(waiting) - 1, part))
            count += len(part)
    if held:
        compute()
    yield from done()


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text; ``und`` with score 0 for null texts and texts without a letter."""
    return map_rows(docs.select(id_col, text_col), lambda rows: predictions(net, rows),
                    f"`{id_col}` bigint, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the labelled rows of a table that are not held out, predict all its rows.

    Rows with a null id are not held out and teach nothing. Without any labelled row every prediction is ``und``. Repeated rows are predicted
    each; other columns are ignored.
    """
    found = predict(docs, fit(docs, id_col, text_col, lang_col), id_col, text_col)
    return found.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "lang_pred", "score")


def contradicted(net: Network, text: str, label: str | None, lang: str, score: float, sure: float = SURE, sure_chars: int = SURE_CHARS) -> bool:
    """Whether a text of at least ``sure_chars`` is surely (score of at least ``sure``) in another language than its label, one that the network has learnt."""
    return label is not None and label != lang and score >= sure and len(text) >= sure_chars and label in net.labels


def accepted(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sure: float = SURE, sure_chars: int = SURE_CHARS) -> DataFrame:
    """The rows with a letter whose label the network doesn't contradict, a null ``lang_col`` filled with the prediction.

    The score is a geometric mean over all windows, so a text that the network is in doubt about in some part (a score below ``sure``) stays
    with its label, as does one of fewer than ``sure_chars`` characters, which tell too little to overrule a label, and one with a label that it never learnt. Without a network every row
    with a letter stays as it is, a null label included. All other columns stay as they are.
    """
    names = docs.columns
    t, known = names.index(text_col), names.index(lang_col)

    def run(rows):
        if net is None:
            letter = letters()
            yield from (row for row in rows if row[t] and letter.search(row[t]))
            return
        for row, lang, score in predictions(net, ((row, row[t]) for row in rows)):
            if lang != UNKNOWN and not contradicted(net, row[t], row[known], lang, score, sure, sure_chars):
                yield row if row[known] is not None else (*row[:known], lang, *row[known + 1:])

    return map_rows(docs, run, docs.schema)
