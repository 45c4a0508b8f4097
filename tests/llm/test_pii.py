"""Operator 1: base spans against the stated patterns, the network's gradients and held-out quality, masking."""

import hashlib
import random
import re

import numpy as np
import pytest

from feedlens.llm import bilstm_crf as lstm
from feedlens.llm import pii
from feedlens.llm.pii_rules import KINDS, base_spans, luhn

from .conftest import table_of

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    tests = {"email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
             "card": lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)), "phone": lambda m: 8 <= len(digits(m)) <= 15}
    return {k: [m.span() for m in re.finditer(p, text) if tests[k](m.group())] for k, p in PATTERNS.items()}


def test_base_spans_equal_the_patterns():
    rng = random.Random(6)
    parts = ["a@b.c", "@", ".", "-", "+", " ", "1", "12", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 010-2000", "é", "x", "(", ")", "a@b", "@@", "\n", "٣"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "@" * 200_000, "+1" * 100_000, "a@" * 100_000, "1 " * 150_000):
        base_spans(text)


def test_numbers_of_any_length():
    for n in (4300, 5000, 300_000):
        assert base_spans("0" * n + ".1.1.1")["ip"] == [(0, n + 6)] and base_spans("1" * n + ".1.1.1")["ip"] == []


@pytest.fixture(scope="module")
def weights():
    x, y = pii.training_windows([], pii.TRAIN_WINDOWS, seed=11)
    return lstm.train(x, y, pii.TAGS, pii.HIDDEN, pii.STEPS, pii.BATCH, pii.RATE, seed=12)


def test_held_out_spans(weights):
    x, y = pii.training_windows([], 500, seed=123)
    got = lstm.viterbi(weights, lstm.emissions(weights, x), np.full(len(x), x.shape[1]))
    inside = lambda tags: {s for s in pii.runs(tags) if s[1] > 0 and s[2] < pii.WINDOW - 8}
    want = found = both = 0
    for a, b in zip(y, got):
        w, g = inside(a), inside(b)
        want, found, both = want + len(w), found + len(g), both + len(w & g)
    assert both / want > 0.85 and both / found > 0.85


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    w = lstm.initial(3, 4, rng)
    for k in vars(w):
        setattr(w, k, getattr(w, k).astype(np.float64))
    x, y = rng.integers(0, 6, (2, 5)), rng.integers(0, 4, (2, 5))
    _, g = lstm.gradients(w, x, y)
    for k in vars(w):
        value = getattr(w, k)
        for at in [tuple(rng.integers(0, min(s, 6)) for s in value.shape) for _ in range(5)]:
            old, h = value[at], 1e-3
            value[at] = old + h
            up, _ = lstm.gradients(w, x, y)
            value[at] = old - h
            down, _ = lstm.gradients(w, x, y)
            value[at] = old
            assert getattr(g, k)[at] == pytest.approx((up - down) / (2 * h), abs=2e-3)


def test_viterbi_is_the_best_path():
    from itertools import product
    rng = np.random.default_rng(4)
    w = lstm.initial(2, 3, rng)
    scores = rng.normal(size=(2, 4, 3)).astype(np.float32)
    value = lambda s, p: w.first[p[0]] + sum(s[t, k] for t, k in enumerate(p)) + sum(w.move[a, b] for a, b in zip(p, p[1:]))
    for row, path, size in zip(scores, lstm.viterbi(w, scores, np.array([4, 3])), (4, 3)):
        assert tuple(path) == max(product(range(3), repeat=size), key=lambda p: value(row, p))


def test_no_window_border_cuts_a_span(weights):
    """The spans of a text don't depend on where its windows fall."""
    for shift in range(0, 2 * pii.STRIDE, 7):
        text = "word " * 30 + "9" * 0 + "x" * shift + " reach us at jane.doe [@] mail.example.com or 0049 301 555 0123 today " + "word " * 30
        (base, added), = pii.find(weights, [text])
        spans = {text[a:b] for k in KINDS for a, b in added[k]}
        assert "jane.doe [@] mail.example.com" in spans


def test_detect_and_redact(spark, odd, odd_rows, clashing, nothing, weights):
    rows = pii.detect(odd, weights).collect()
    assert len(rows) == len(odd_rows)
    texts = {r[0]: r[1] or "" for r in odd_rows}
    for r in rows:
        base = plain(texts[r["doc_id"]])
        listed = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in base[k])
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [len(base[k]) for k in KINDS]
        assert set(listed.split(",")) <= set(r["spans"].split(",")) and len(list(filter(None, r["spans"].split(",")))) == r["n_added"] + sum(map(len, base.values()))
    out = {r["doc_id"]: r for r in pii.redact(odd, weights).collect()}
    assert out[14]["text"] == "mail [EMAIL], ip [IP], tel [PHONE]" and out[14]["n_chars"] == len(out[14]["text"])
    assert all(out[r[0]]["text"] == r[1] for r in odd_rows if r[0] in (1, 2, 4, 7, 12, 13))
    assert pii.detect(nothing, weights).count() == 0 and pii.redact(nothing, weights).count() == 0
    assert table_of(pii.detect(clashing, weights)) == table_of(pii.detect(odd, weights))
    assert pii.redact(clashing, weights).columns == clashing.columns


@pytest.mark.parametrize("text, span", [
    ("write to jane.doe[at]example[dot]org please", "jane.doe[at]example[dot]org"),
    ("write to annemarie.katharina.vonderhohenwiese-mittelstaedt [@] mail.example.com now", "annemarie.katharina.vonderhohenwiese-mittelstaedt [@] mail.example.com"),
])
def test_written_out_and_long_addresses(weights, text, span):
    (_, added), = pii.find(weights, [text])
    assert [text[a:b] for a, b in added["email"]] == [span]


def test_a_stretch_is_read_on_while_its_end_is_tagged(weights, monkeypatch):
    """Tags that always reach the end of what is read: the whole text is read, in a few rounds."""
    rounds = []

    def all_tagged(w, parts):
        rounds.append([len(p) for p in parts])
        return [np.array([1] + [2] * (len(p) - 1)) for p in parts]

    monkeypatch.setattr(pii, "tagged", all_tagged)
    (k, start, tags), = pii.read(weights, ["x" * 3000 + "@" + "y" * 2000])
    assert (k, start, len(tags)) == (0, 0, 5001) and len(rounds) < 10


def test_overlapping_spans_are_masked_once():
    spans = {k: [] for k in KINDS} | {"card": [(2, 10)], "phone": [(5, 12)]}
    assert pii.masked("a 34567890123 b", spans, {k: [] for k in KINDS}) == "a [CARD]3 b"


def test_held_out_precision_and_recall_are_near_the_published_ones(weights):
    x, y = pii.training_windows([], 500, seed=123)
    got = lstm.viterbi(weights, lstm.emissions(weights, x), np.full(len(x), x.shape[1]))
    inside = lambda tags: {s for s in pii.runs(tags) if s[1] > 0 and s[2] < pii.WINDOW - 8}
    want, found = ({(k, *s) for k, row in enumerate(rows) for s in inside(row)} for rows in (y, got))
    assert len(want & found) / len(found) >= 0.98 and len(want & found) / len(want) >= 0.96
