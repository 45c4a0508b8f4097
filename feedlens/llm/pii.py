"""Operator 1: personal data by base patterns and a character BiLSTM-CRF.

The network learns from labelled spans: personal data of many written forms, and look-alikes without a
label, set into surroundings from a bounded sample of the corpus. It adds spans that the patterns miss (spaced, bracketed or
written-out addresses, numbers without plus sign or with other separators). Every span of its four
kinds holds a digit, an @ or a bracketed "at", so stretches around those are read; each stretch is
covered by overlapping windows. Their tag scores are blended by distance from the windows' ends, and
one Viterbi pass over the whole stretch decides, so that no window border cuts a span. A span that reaches the end of
its stretch has the stretch read on until it doesn't, and an address ends where its first and last word do.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bilstm_crf as lstm
from .common import map_rows, sample
from .pii_rules import KINDS, base_spans, digits_of, luhn
from .tokens import groups

TAGS = 1 + 2 * len(KINDS)
HIDDEN, WINDOW, STRIDE = 20, 96, 48
#: Characters around a digit, @ or "at" that are read with it, and read on where a span reaches their end.
CONTEXT = 32
#: Surroundings sampled from the corpus at most, labelled windows made from them, and the training.
SAMPLE_DOCS, TRAIN_WINDOWS, WINDOWS_PER_TEXT, STEPS, BATCH, RATE = 400, 6000, 4, 420, 48, 0.025
#: Text handled together by a task, and windows computed together.
GROUP_CHARS, BLOCK = 2 << 20, 256

_SYMBOL = re.compile("[0-9@]")
_AT = r"[(\[{] ?(?:at|AT) ?[)\]}]"
_TRIGGER = re.compile(f"[0-9@]|{_AT}")
_WRITTEN = re.compile(_AT + r".*(?:\.|[(\[{] ?(?:dot|DOT) ?[)\]}])", re.S)
#: Characters of an address's first or last word.
_WORD = re.compile(r"[A-Za-z0-9._%+-]")
_FILLER = ("please see the note below and write to us before the end of the month, as agreed in the letter. "
           "The parcel left the store and will arrive soon; no other action is needed from your side. ")


def labelled_item(rng: np.random.Generator) -> tuple[str, int]:
    """A string and its kind's number, or -1 for a look-alike that is no personal data."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9)))
    pick = lambda *options: options[rng.integers(len(options))]
    kind = int(rng.integers(0, 9))
    if kind <= 1:
        name = pick("", ".", "_", "-", "+").join(word() for _ in range(pick(1, 1, 1, 2, 2, 2, 2, 4))) + pick("", "", digits(2))
        host = pick(word(), "mail" + digits(1), word() + "-" + word())
        top = pick("com", "org", "net", "de", "example.com", "co.uk", "fr", "es")
        at, dot = pick(("@", "."), ("@", "."), ("@", "."), (" @ ", "."), ("[@]", "."), ("(@)", "."), ("@", "[.]"), ("@", " . "),
                       (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", "."), ("[at]", "."))
        return (name or "a") + at + host + dot + top.replace(".", dot), 0
    if kind == 2:
        dot = pick(".", ".", ".", " . ", "[.]", "(.)")
        return dot.join(str(v) for v in rng.integers(0, 256, 4)), 1
    if kind == 3:
        body = pick("4", "5", "3", "6", digits(1)) + digits(14)
        number = body + next(d for d in "0123456789" if luhn(body + d))
        gap = pick("", "", " ", "-", ".", "/")
        return gap.join(number[k:k + 4] for k in range(0, 16, 4)), 2
    if kind in (4, 5):
        a, b, c, land = digits(3), digits(3), digits(4), pick("1", "33", "34", "49", "44")
        return pick(f"+{land} ({a}) {b}-{c}", f"+{land} {a} {b} {c}", f"+{land}-{a}-{b}-{c}", f"+{land}{a}{b}{c}",
                    f"00{land} {a} {b} {c}", f"({a}) {b}-{c}", f"+{land}/{a}/{b}{c}", f"+{land} ({a}) {b}-{c}"), 3
    return pick(f'token = "{"".join(rng.choice(list("0123456789abcdef"), 40))}"', f"Version {digits(1)}.{digits(1)}",
                f"CC BY-NC {digits(1)}.{digits(1)}.", digits(4), f"{digits(2)}/{digits(2)}/{digits(4)}", f"{digits(4)}-{digits(2)}-{digits(2)}",
                f"{digits(3)}.{digits(2)} EUR", f"page {digits(3)}", f"v{digits(1)}.{digits(2)}.{digits(1)}", f"@{word()}", f"(at {word()})", f"[{word()}]", digits(6),
                f"{digits(1)},{digits(3)},{digits(3)}", f"{digits(2)}:{digits(2)}:{digits(2)}", f"ISBN {digits(3)}-{digits(10)}", digits(24)), -1


def training_windows(texts: list[str], n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of labelled characters: pieces of the texts with items set in, at any place of the window."""
    rng = np.random.default_rng(seed)
    texts = [t for t in texts if not _SYMBOL.search(t)] or [_FILLER]
    x, y = np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), np.int64)
    text, tags = "", []
    for k in range(n):
        if k % WINDOWS_PER_TEXT == 0:
            text, tags = "", []
        while len(text) < 3 * WINDOW:
            around = texts[rng.integers(len(texts))]
            at = int(rng.integers(0, max(1, len(around) - 60)))
            plain = around[at:at + int(rng.integers(4, 60))]
            item, kind = labelled_item(rng)
            before, after = rng.choice([" ", " ", " ", "\n", ": ", "(", "*** ", '"'], 2)
            end = str(rng.choice(["", "", "", ".", ",", "!!", "###", ";"]))
            marked = [0] * len(item) if kind < 0 else [1 + 2 * kind] + [2 + 2 * kind] * (len(item) - 1)
            text += plain + str(before) + item + end + str(after).strip('(*": ') + " "
            tags += [0] * (len(plain) + len(str(before))) + marked
            tags += [0] * (len(text) - len(tags))
        at = int(rng.integers(0, WINDOW))
        size = WINDOW if rng.random() < 0.7 else int(rng.integers(WINDOW // 4, WINDOW))
        x[k, :size] = lstm.char_ids(text[at:at + size])
        y[k, :size] = tags[at:at + size]
    return x, y


def fit(docs: DataFrame, text_col: str = "text") -> lstm.Weights:
    """Train on surroundings from at most ``SAMPLE_DOCS`` texts, the first by a hash; an empty table leaves built-in ones."""
    key = F.xxhash64(text_col)
    texts = docs.where(F.col(text_col).isNotNull()).select(key.alias("key"), F.substring(
        F.col(text_col), F.pmod(key, F.greatest(F.length(text_col), F.lit(1))).cast("int") + 1, F.lit(400)).alias("text"))
    rows = sample(texts, F.col("key"), SAMPLE_DOCS).where("text <> ''").collect()
    rows.sort()
    x, y = training_windows([r["text"] for r in rows], TRAIN_WINDOWS, seed=11)
    return lstm.train(x, y, TAGS, HIDDEN, STEPS, BATCH, RATE, seed=12)


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text within ``CONTEXT`` characters of a digit, @ or bracketed "at", merged where they meet."""
    return joined((max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)) for m in _TRIGGER.finditer(text))


def joined(parts: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in parts:
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


_RAMP = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]


def tagged(w: lstm.Weights, parts: list[np.ndarray]) -> list[np.ndarray]:
    """Tags of stretches given as character ids: blended window scores, then one Viterbi pass for each."""
    where, windows = [], []
    for k, ids in enumerate(parts):
        for at in range(0, max(1, len(ids) - WINDOW + STRIDE), STRIDE):
            window = np.zeros(WINDOW, np.int64)
            piece = ids[at:at + WINDOW]
            window[:len(piece)] = piece
            where.append((k, at, len(piece)))
            windows.append(window)
    total = [np.zeros((len(ids), TAGS), np.float32) for ids in parts]
    weight = [np.zeros((len(ids), 1), np.float32) for ids in parts]
    for at in range(0, len(windows), BLOCK):
        scores = lstm.emissions(w, np.stack(windows[at:at + BLOCK]))
        for (k, start, size), s in zip(where[at:at + BLOCK], scores):
            total[k][start:start + size] += s[:size] * _RAMP[:size]
            weight[k][start:start + size] += _RAMP[:size]
    out: list = [None] * len(parts)
    order = sorted(range(len(parts)), key=lambda k: len(parts[k]))
    at = 0
    while at < len(order):
        rows = order[at:at + BLOCK]
        while len(rows) > 1 and len(rows) * len(parts[rows[-1]]) > BLOCK * 4 * WINDOW:
            rows = rows[:len(rows) // 2]
        at += len(rows)
        lengths = np.array([len(parts[k]) for k in rows])
        scores = np.zeros((len(rows), lengths[-1], TAGS), np.float32)
        for r, k in enumerate(rows):
            scores[r, :lengths[r]] = total[k] / weight[k]
        for k, tags in zip(rows, lstm.viterbi(w, scores, lengths)):
            out[k] = tags
    return out


def runs(tags: np.ndarray) -> Iterator[tuple[str, int, int]]:
    """Spans of a tag sequence: a B or I tag and the I tags of its kind after it."""
    k = 0
    while k < len(tags):
        if tags[k] == 0:
            k += 1
            continue
        kind, end = (tags[k] - 1) // 2, k + 1
        while end < len(tags) and tags[end] == 2 + 2 * kind:
            end += 1
        yield KINDS[kind], k, end
        k = end


def plausible(kind: str, text: str) -> bool:
    """What any written form of a kind must hold."""
    n = len(digits_of(text))
    return {"email": ("@" in text[1:-1] and "." in text) or _WRITTEN.search(text, 1) is not None, "ip": 4 <= n <= 12, "card": 16 <= n <= 19, "phone": 8 <= n <= 15}[kind]


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and not (text[start].isalnum() or text[start] in "+("):
        start += 1
    while start < end and not text[end - 1].isalnum():
        end -= 1
    return start, end


def completed(kind: str, text: str, start: int, end: int) -> tuple[int, int]:
    """The span with the whole of its first and last word; of numbers, with the digits that go on."""
    goes_on = _WORD if kind == "email" else _SYMBOL
    while start > 0 and goes_on.match(text[start - 1]):
        start -= 1
    while end < len(text) and goes_on.match(text[end]):
        end += 1
    return start, end


def read(w: lstm.Weights, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text number, start, tags) of each stretch; one whose first or last character is tagged is read on, doubling, to its text's end at most."""
    wanted = [(k, start, end, CONTEXT) for k, text in enumerate(texts) for start, end in stretches(text)]
    while wanted:
        again = []
        for (k, start, end, step), tags in zip(wanted, tagged(w, [lstm.char_ids(texts[k][a:b]) for k, a, b, _ in wanted])):
            before = step if tags[0] and start else 0
            after = step if tags[-1] and end < len(texts[k]) else 0
            if before or after:
                again.append((k, max(0, start - before), min(len(texts[k]), end + after), 2 * step))
            else:
                yield k, start, tags
        wanted = again


def find(w: lstm.Weights, texts: list[str]) -> list[tuple[dict, dict]]:
    """(base spans, spans that the network adds) by kind for each text; added ones touch no base span and no other."""
    base = [base_spans(t) for t in texts]
    added: list[dict] = [{kind: [] for kind in KINDS} for _ in texts]
    taken: list[list[tuple[int, int]]] = [sorted(s for spans in b.values() for s in spans) for b in base]
    found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for k, start, tags in read(w, texts):
        found[k] += [(start + a, start + b, kind) for kind, a, b in runs(tags)]
    for k, spans in enumerate(found):
        for a, b, kind in sorted(spans):
            a, b = trimmed(texts[k], *completed(kind, texts[k], a, b))
            if a < b and plausible(kind, texts[k][a:b]) and not any(x < b and a < y for x, y in taken[k]):
                added[k][kind].append((a, b))
                taken[k].append((a, b))
    return list(zip(base, added))


def listed(*spans: dict) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(s for found in spans for s in found[kind]))


def detect(df: DataFrame, weights: lstm.Weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every whole text: counts and a digest of the base spans, all spans as text, the network's count.

    Null and empty texts have none. Repeated rows and null ids stay rows; other columns are ignored.
    """
    def run(rows):
        for group in groups(rows, lambda r: len(r[1] or "") + 64, GROUP_CHARS):
            for (doc, _), (base, added) in zip(group, find(weights, [t or "" for _, t in group])):
                yield (doc, *(len(base[kind]) for kind in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(),
                       listed(base, added), sum(map(len, added.values())))

    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    return map_rows(df.select(id_col, text_col), run,
                    f"`{id_col}` bigint, {counts}, base_sha256 string, spans string, n_added bigint")


def masked(text: str, base: dict, added: dict) -> str:
    """The text with each personal span, or union of overlapping ones, replaced by its first kind in capitals."""
    out, done = [], 0
    for a, b, kind in sorted((a, b, kind) for found in (base, added) for kind in KINDS for a, b in found[kind]):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(df: DataFrame, weights: lstm.Weights, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows with personal data masked and ``length_col`` (if there) set anew; null texts and texts without any stay as they are."""
    schema = df.schema
    names = df.columns
    t = names.index(text_col)
    n = names.index(length_col) if length_col in names else None

    def run(rows):
        for group in groups(rows, lambda r: len(r[t] or "") + 64, GROUP_CHARS):
            for row, (base, added) in zip(group, find(weights, [r[t] or "" for r in group])):
                if row[t] is not None and any(s for found in (base, added) for s in found.values()):
                    row = list(row)
                    row[t] = masked(row[t], base, added)
                    if n is not None:
                        row[n] = len(row[t])
                yield tuple(row)

    return map_rows(df, run, schema)
