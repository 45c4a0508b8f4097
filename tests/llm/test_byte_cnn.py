"""Operator 3: gradients, held-out accuracy, and odd rows."""

import zlib

import numpy as np
import pytest

from feedlens.llm import byte_cnn
from feedlens.llm.common import table
from tests.conftest import SF_CHECK

from .conftest import SCHEMA, table_of


def test_held_out_accuracy_on_the_corpus(spark):
    docs = table(spark, SF_CHECK, "documents")
    rows = byte_cnn.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and r["lang"] is not None]
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_teach_nothing(spark):
    docs = table(spark, SF_CHECK, "documents")
    wrong = docs.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 4 = 2 then 'xx' else lang end as lang")
    a, b = byte_cnn.fit(docs), byte_cnn.fit(wrong)
    assert a.labels == b.labels and np.array_equal(a.conv, b.conv)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = byte_cnn.train(["abc def " * 9, "xyz uvw " * 9, "hello you " * 8], ["a", "b", "a"])
    x, y, weight = rng.integers(0, 256, (3, 40)).astype(np.uint8), np.array([0, 1, 0]), np.ones(3, np.float32)
    for k in ("embed", "conv", "bias", "out", "out_bias"):
        setattr(net, k, getattr(net, k).astype(np.float64))
    mask = np.ones_like(net.conv)
    loss = lambda: -net.log_probabilities(x)[np.arange(3), y].mean()
    grads = byte_cnn.gradients(net, x, y, weight, mask)
    for k in ("embed", "conv", "bias", "out", "out_bias"):
        value = getattr(net, k)
        for at in [tuple(rng.integers(0, s) for s in value.shape) for _ in range(6)]:
            old, h = value[at], 1e-6
            value[at] = old + h
            up = loss()
            value[at] = old - h
            down = loss()
            value[at] = old
            assert grads[k][at] == pytest.approx((up - down) / (2 * h), abs=1e-4)


def test_blocks_of_windows_change_nothing(spark, odd, monkeypatch):
    net = byte_cnn.train(["the of and to in " * 20, "der die das und " * 20], ["en", "de"])
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = list(byte_cnn.predictions(net, iter(rows)))
    monkeypatch.setattr(byte_cnn, "BLOCK", 3)
    got = list(byte_cnn.predictions(net, iter(rows)))
    assert [g[:2] for g in got] == [w[:2] for w in want] and [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-5)
    by = {w[0]: w for w in want}
    assert all(by[k][1:] == ("und", 0.0) for k in (1, 2, 3, 9)) and by[13][1] != "und"


def test_empty_unlabelled_and_clashing(spark, nothing, odd, clashing):
    assert byte_cnn.identify(nothing).count() == 0
    bare = spark.createDataFrame([(1, "some text", None, None, None)], SCHEMA)
    assert table_of(byte_cnn.identify(bare)) == [(1, False, "und", 0.0)]
    assert table_of(byte_cnn.identify(clashing)) == table_of(byte_cnn.identify(odd))


def test_predictions_reject_wrong_labels_and_keep_clean_documents(spark):
    docs = table(spark, SF_CHECK, "documents").where("text is not null and lang is not null")
    held = "crc32(cast(doc_id as string)) % 4 = 2"
    mixed = docs.selectExpr("doc_id", "text", f"case when {held} and doc_id % 3 = 0 then if(lang = 'en', 'de', 'en') "
                            f"when {held} and doc_id % 3 = 1 then null when {held} and doc_id % 6 = 2 then 'xx' else lang end as lang")
    rows, want = mixed.collect(), {r["doc_id"]: r["lang"] for r in docs.collect()}
    net = byte_cnn.fit(mixed)
    assert {"en", "de"} <= set(net.labels)
    got = {r["doc_id"]: r["lang"] for r in byte_cnn.accepted(mixed, net).collect()}
    wrong = {r["doc_id"] for r in rows if r["lang"] not in (None, "xx", want[r["doc_id"]]) and len(r["text"]) >= byte_cnn.SURE_CHARS}
    clean = {r["doc_id"] for r in rows if r["lang"] == want[r["doc_id"]]}
    empty = {r["doc_id"] for r in rows if r["lang"] is None}
    assert len(wrong) > 20 and len(wrong - set(got)) / len(wrong) > 0.9
    assert clean <= set(got) and empty <= set(got) and {r["doc_id"] for r in rows if r["lang"] == "xx"} <= set(got)
    assert sum(got[k] == want[k] for k in empty) / len(empty) > 0.97


def test_doubt_and_unlearnt_labels_keep_a_row():
    net = byte_cnn.train(["abc def " * 9, "xyz uvw " * 9], ["a", "b"])
    text = "xyz " * 40
    assert byte_cnn.contradicted(net, text, "a", "b", 0.95) and not byte_cnn.contradicted(net, text, "a", "b", 0.5)
    assert not byte_cnn.contradicted(net, text[:100], "a", "b", 0.95)
    assert not any(byte_cnn.contradicted(net, text, label, "b", 0.95) for label in (None, "b", "c"))


def test_an_unlabelled_table_keeps_its_texts(spark, odd):
    bare = odd.selectExpr("doc_id", "text", "cast(null as string) as lang", "source", "n_chars")
    net = byte_cnn.fit(bare)
    assert net is None
    assert table_of(byte_cnn.accepted(bare, net)) == table_of(bare.where(r"text rlike '\\p{L}'"))


def test_the_forward_pass_equals_plain_loops():
    """Each filter of each width at each place, the largest value, and softmax, byte by byte; then whole texts over several windows."""
    net = byte_cnn.train(["abc def " * 9, "xyz uvw é " * 9, "hello you " * 8], ["a", "b", "a"])
    width_of = [w for w in byte_cnn.WIDTHS for _ in range(byte_cnn.FILTERS)]
    longest = max(byte_cnn.WIDTHS)

    def plain(window):
        pooled = []
        for f, width in enumerate(width_of):
            best = -np.inf
            for at in range(len(window) - longest + 1):
                total = 0.0
                for k in range(width):
                    for e in range(byte_cnn.EMBED):
                        total += float(net.embed[window[at + k], e]) * float(net.conv[k * byte_cnn.EMBED + e, f])
                best = max(best, total)
            pooled.append(max(0.0, best + float(net.bias[f])))
        z = [sum(p * float(net.out[f, c]) for f, p in enumerate(pooled)) + float(net.out_bias[c]) for c in range(len(net.labels))]
        return [v - max(z) - np.log(sum(np.exp(u - max(z)) for u in z)) for v in z]

    assert not any(net.conv[width * byte_cnn.EMBED:, f].any() for f, width in enumerate(width_of))  # a filter ends at its width
    texts = ["Abc xyz", "é" * 200 + " hello " * 30, "x"]
    want = []
    for text in texts:
        data = text.lower().encode()
        data += bytes(-len(data) % byte_cnn.WINDOW)
        logs = np.array([plain(data[k:k + byte_cnn.WINDOW]) for k in range(0, len(data), byte_cnn.WINDOW)]).mean(axis=0)
        want.append((net.labels[int(logs.argmax())], float(np.exp(logs.max()))))
    got = list(byte_cnn.predictions(net, enumerate(texts)))
    assert [(k, lang) for k, lang, _ in got] == [(k, lang) for k, (lang, _) in enumerate(want)]
    assert [score for *_, score in got] == pytest.approx([score for _, score in want], abs=1e-5)
