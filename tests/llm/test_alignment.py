"""Operator 13 against counting by dictionaries over the tokenizer libraries' own output."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from feedlens.llm import alignment, pair_runs

from .conftest import words, table_of

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def token_spans(text, side_a, side_b):
    """(ids, ends) of both sides, None where the bytes differ from a space and the text."""
    shown = alignment.byte_level_alphabet()
    back = {c: b for b, c in shown.items()}
    a = side_a.encode(" " + text, add_special_tokens=False).ids
    b = side_b.encode(text)
    bytes_a = [bytes(back[c] for c in side_a.id_to_token(i)) for i in a]
    bytes_b = []
    for i in b:
        piece = side_b.id_to_piece(i)
        bytes_b.append(bytes([int(piece[1:-1], 16)]) if side_b.is_byte(i) else piece.replace("▁", " ").encode())
    want = (" " + text).encode()
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None
    return (a, np.cumsum([len(x) for x in bytes_a]).tolist()), (b, np.cumsum([len(x) for x in bytes_b]).tolist())


def brute_force(rows):
    side_a = Tokenizer.from_file(A)
    side_a.encode_special_tokens = True
    side_b = sentencepiece.SentencePieceProcessor(model_file=B)
    found, held = [], Counter()
    for _, text in rows:
        spans = token_spans(text, side_a, side_b) if text else None
        links, groups = [], []
        if spans:
            (a, ends_a), (b, ends_b) = spans
            for i, (x, end_x) in enumerate(zip(a, ends_a)):
                for y, start_y, end_y in zip(b, [0, *ends_b], ends_b):
                    if start_y < end_x and (ends_a[i - 1] if i else 0) < end_y:
                        links.append((x, y))
            common = sorted(set(ends_a) & set(ends_b))
            for lo, hi in zip([0, *common], common):
                groups.append(",".join(str(i) for i, e in zip(a, ends_a) if lo < e <= hi) + "|"
                              + ",".join(str(i) for i, e in zip(b, ends_b) if lo < e <= hi))
        found.append((spans, links, groups))
        held.update(set(links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for (doc, _), (spans, links, groups) in zip(rows, found):
        n_a, n_b = (len(spans[0][0]), len(spans[1][0])) if spans else (0, 0)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if spans else ""
        out.append((doc, n_a, n_b, len(groups), len(links), sum(held[k] == best[k[0]] for k in links), sum(held[k] for k in links), digest))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    odd = [(1, None), (2, ""), (None, "no id"), (3, " \t\n "), (4, "holds ▁ itself"), (5, "end <|endoftext|> <s></s> <0x41> start"),
           (6, "é ñ 漢字 \U0001f600 x" * 3), (7, "a  b   c\r\n\nd"), (8, " leading"), (9, "x" * 300), (9, "x" * 300), (10, "\x00\x1c ok"),
           (11, "ﬁ ½ ﷺ"), (12, "the " * 200)]
    return odd + [(100 + k, words(rng, 1 + k % 40)) for k in range(60)]


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id bigint, text string, part string, block int").repartition(parts)


def test_op13_equals_dictionaries_with_nulls_ties_repeats_and_clashing_names(spark, rows):
    assert table_of(alignment.align(frame(spark, rows), A, B)) == brute_force(rows)


def test_op13_small_chunks_and_a_hot_pair(rows, monkeypatch):
    """Chunks that cut keys, two merge rounds, and one pair in a third of all records."""
    more = rows + [(1000 + k, "the the of the") for k in range(60)]
    monkeypatch.setattr(alignment, "CHUNK_RECORDS", 7)  # Spark's workers wouldn't see this: the task side is run here
    parts = alignment.LEAST_PARTS
    pair = alignment.tokenizer_pair(A, B)
    texts = [t for _, t in more if t]
    links, docs = [], []
    for k, ids in enumerate(pair.encode(texts)):
        if ids is not None:
            _, _, keys = pair.align(*ids)
            links.append(keys)
            docs.append(np.full(len(keys), k))
    runs = list(alignment.runs_of_block(np.concatenate(links), np.concatenate(docs), parts))
    assert max(r[1] for r in runs) > 3
    total, n_best = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    for part in range(parts):
        own = [r for r in runs if r[0] == part]
        if not own:
            continue
        first_round = [pair_runs.merge([(r[4], r[2]) for r in own[k::3]]) for k in range(3)]
        keys, counts = pair_runs.merge([(pair_runs.pack_keys(k, c), len(k)) for k, c in first_round])
        best = pair_runs.side_maxima(keys, counts)
        for r in own:
            chunk = dict(zip(("n_keys", "n_records", "keys", "docs"), r[2:]))
            which, more_best, more_sum = alignment.contributions(chunk, keys, counts, best)
            np.add.at(n_best, which, more_best)
            np.add.at(total, which, more_sum)
    want = {row[-1]: row[5:7] for row in brute_force(more) if row[-1]}
    for k, (text, ids) in enumerate(zip(texts, pair.encode(texts))):
        if ids is not None:
            digest = hashlib.sha256(pair.align(*ids)[1].encode()).hexdigest()
            assert (n_best[k], total[k]) == want[digest]


def test_op13_rounds_and_dealt_tasks_in_spark(spark, rows, monkeypatch):
    """Driver-side bounds: merges of two runs in several rounds, one chunk a task."""
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    monkeypatch.setattr(alignment, "CHUNKS", 1)
    assert table_of(alignment.align(frame(spark, rows, 7), A, B)) == brute_force(rows)


def test_op13_empty_table(spark):
    found = alignment.align(spark.createDataFrame([], "doc_id bigint, text string"), A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.collect() == []


def test_ranks_of_the_file_encode_as_the_library(rows, tmp_path):
    """Every code point of two planes in several surroundings, and a file whose merges are out of order (library path)."""
    encode, tokens = alignment.byte_level_encoder(A)
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)} {chr(c)}1{chr(c)}  {chr(c)}{chr(c)}!" for c in points[k:k + 64]) for k in range(0, len(points), 64)]
    texts += [t for _, t in rows if t]
    assert encode(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    spec = json.loads(open(A, encoding="utf-8").read())
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    (tmp_path / "other.json").write_text(json.dumps(spec), encoding="utf-8")
    other, other_tokens = alignment.byte_level_encoder(str(tmp_path / "other.json"))
    reversed_ = Tokenizer.from_file(str(tmp_path / "other.json"))
    assert other_tokens == tokens and other(["some words here"]) == [reversed_.encode("some words here", add_special_tokens=False).ids]


def test_merge_equals_a_dictionary():
    rng = np.random.default_rng(3)
    held, runs = Counter(), []
    for _ in range(20):
        keys = np.unique(rng.integers(0, 40, 30) * pair_runs.WIDTH + rng.integers(0, 9, 30))
        counts = rng.integers(1, 2**40, len(keys))
        held.update(dict(zip(keys.tolist(), counts.tolist())))
        runs.append((pair_runs.pack_keys(keys, counts), len(keys)))
    keys, counts = pair_runs.merge(runs + [(pair_runs.pack_keys(keys[:0], counts[:0]), 0)])
    assert dict(zip(keys.tolist(), counts.tolist())) == held and (np.diff(keys) > 0).all()
    most = {}
    for k, n in held.items():
        most[k // pair_runs.WIDTH] = max(n, most.get(k // pair_runs.WIDTH, 0))
    assert pair_runs.side_maxima(keys, counts).tolist() == [held[k] == most[k // pair_runs.WIDTH] for k in keys.tolist()]
