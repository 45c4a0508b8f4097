"""Operators 4, 7 and 9 against the tokenizer libraries."""

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from feedlens.llm import attribution, bpe, packing
from feedlens.llm.bpe import Bpe
from feedlens.llm.tokens import WordEncoder

from .conftest import table_of

MULTI, PLAIN, WORD = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


def encoder(path):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_op4_equals_the_library_and_decodes(odd, odd_rows):
    e = encoder(MULTI)
    want = []
    for doc, text, *_ in odd_rows:
        ids = e.encode_ordinary(text or "")
        want.append((doc, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert table_of(bpe.round_trip(odd, MULTI, P.PATTERN)) == sorted(want, key=repr)


def test_op4_encode_and_decode_apart(odd, odd_rows):
    ids = bpe.encode(odd, MULTI, P.PATTERN)
    got = table_of(bpe.decode(ids, MULTI, P.PATTERN))
    assert [(d, bytes(b)) for d, b in got] == [
        (d, b) for d, b in sorted(((r[0], (r[1] or "").encode()) for r in odd_rows), key=lambda r: repr((r[0], bytearray(r[1]))))]


def test_ids_that_are_missed_are_filled_in_at_their_places():
    """Each miss noted with its list, repeated ones too, while the keys themselves may be gone; nothing stays for the next texts."""
    from feedlens.llm.tokens import Known
    known = Known({"a": b"1"})
    first, second, third = known.find(iter("xaxya")), known.find(iter("aa")), known.find(iter("y"))
    assert first == [None, b"1", None, None, b"1"] and known.missed == ["x", "x", "y", "y"]
    known.fill({"x": b"8", "y": b"9"})
    assert (first, second, third) == ([b"8", b"1", b"8", b"9", b"1"], [b"1", b"1"], [b"9"])
    assert not known.missed and not known.gaps and dict(known) == {"a": b"1"}


def test_op4_contracts_pieces_of_one_byte_and_of_many_in_their_order():
    one, e = Bpe(MULTI, P.PATTERN), encoder(MULTI)
    pieces = [b"a", b" zqxjkv", b"b", b"a" * 512, "\u6f22\u5b57".encode(), b"\xff"]
    got = [np.frombuffer(ids, dtype=np.int32).tolist() for ids in one.contract(pieces)]
    assert [e.decode_bytes(ids) for ids in got] == pieces
    assert got[:5] == [e.encode_ordinary(p.decode()) for p in pieces[:5]]
    assert one.contract(pieces[::-1]) == one.contract(pieces)[::-1]


def test_op4_memory_bounds_change_nothing(monkeypatch):
    texts = ["the quick brown foxes", "  spaces   and\n\nlines ", "", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "naïve façade 漢字"]
    want = [encoder(MULTI).encode_ordinary(t) for t in texts]
    import feedlens.llm.bpe as module
    for name, value in (("QUERY_BYTES", 6), ("DECODE_TOKENS", 3), ("CACHE_PIECES", 2)):
        monkeypatch.setattr(module, name, value)
    one = Bpe(MULTI, P.PATTERN)
    assert [ids.tolist() for ids in one.encode(texts)] == want
    assert one.decode([np.array(w, dtype=np.int32) for w in want]) == [t.encode() for t in texts]


def test_op4_long_pieces_take_little_time_and_equal_the_library(monkeypatch):
    """Texts without a space: the heap against the library, and against the recursion on pieces that both can take."""
    import random
    import time

    import feedlens.llm.bpe as module
    rng = random.Random(5)
    e, one = encoder(MULTI), Bpe(MULTI, P.PATTERN)
    texts = ["".join(rng.choices("etaoinshrdlu", k=200_000)), "ab" * 60_000, "a" * 100_000, "漢字" * 20_000, "x" + "=" * 50_000]
    start = time.process_time()
    got = one.encode(texts)
    assert time.process_time() - start < 30
    assert [ids.tolist() for ids in got] == [e.encode_ordinary(t) for t in texts]
    short = ["".join(rng.choices("etaoin", k=rng.randint(2, 60))) for _ in range(300)] + ["a" * n for n in range(2, 40)]
    assert [one.contract_long(t.encode()) for t in short] == [np.frombuffer(ids, dtype=np.int32).tolist() for ids in one.contract([t.encode() for t in short])]


def test_op4_white_space_of_all_kinds():
    import random
    rng = random.Random(8)
    e, one = encoder(MULTI), Bpe(MULTI, P.PATTERN)
    parts = [" ", " ", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "a", "the", "It's", "'ll", "12", "é", "漢", "!", ".", "\x1c", "\x85", "_"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    assert [ids.tolist() for ids in one.encode(texts)] == [e.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("rule", attribution.RULES)
def test_op7_counts_equal_a_plain_attribution(odd, odd_rows, rule):
    e = encoder(PLAIN)
    got = defaultdict(list)
    for r in attribution.token_counts(odd, PLAIN, P.PATTERN, fields=("source", "text"), rule=rule, separator="\n").collect():
        got[r["doc_id"], r["doc_tokens"]].append(r)
    for doc, text, _, source, _ in odd_rows:
        whole = (source or "") + "\n" + (text or "")
        ids = e.encode_ordinary(whole)
        rows = sorted(got[doc, len(ids)], key=lambda r: (r["char_start"], r["char_end"]))
        assert rows[0]["char_start"] == 0 and rows[-1]["char_end"] == len(whole)
        spans = [(len(whole[:r["char_start"]].encode()), len(whole[:r["char_end"]].encode())) for r in rows]
        want, crossing, at = [0] * len(rows), [0] * len(rows), 0
        for token in ids:
            end = at + len(e.decode_single_token_bytes(token))
            shares = [max(0, min(end, b) - max(at, a)) for a, b in spans]
            k = shares.index(max(shares)) if rule == "largest" else next(k for k, s in enumerate(shares) if s)
            want[k] += 1
            crossing[k] += sum(s > 0 for s in shares) > 1
            at = end
        if doc != 5:  # a repeated row has its sections twice
            assert [r["n_tokens"] for r in rows] == want and [r["n_crossing"] for r in rows] == crossing


def test_op7_a_token_over_a_border_goes_where_most_of_it_lies():
    counts, crossing = attribution.attribute(np.array([0, 3, 3, 5]), 9, np.array([2, 3, 1, 3]), "largest")
    assert counts.tolist() == [1, 0, 1, 2] and crossing.tolist() == [0, 0, 1, 0]
    assert attribution.attribute(np.array([0, 3, 3, 5]), 9, np.array([2, 3, 1, 3]), "start")[0].tolist() == [2, 0, 0, 2]


def pieces_hold(rows, texts, window):
    e = Tokenizer.from_file(WORD)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, text in texts.items():
        ids = np.array([*e.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for inside in by_sequence.values():
        at = 0
        for r in sorted(inside, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window and at & (at - 1) == 0 and {r["window_length"] for r in inside} == {at}
    steps = defaultdict(set)
    for r in rows:
        steps[r["step_group"]].add((r["window_length"], r["sequence_id"]))
    for inside in steps.values():
        assert len({size for size, _ in inside}) == 1 and sum(size for size, _ in inside) <= packing.STEP_TOKENS


def test_op9_every_id_lies_in_one_piece_and_no_sequence_is_padded(odd, odd_rows):
    once = odd.dropDuplicates()
    rows = packing.pack(once, WORD).collect()
    pieces_hold(rows, {r[0]: r[1] for r in odd_rows}, 2048)


def test_op9_small_windows_and_flushes(odd, odd_rows):
    once = odd.dropDuplicates()
    rows = packing.pack(once, WORD, window=64, flush_tokens=100).collect()
    pieces_hold(rows, {r[0]: r[1] for r in odd_rows}, 64)


def test_words_are_encoded_as_the_tokenizer_does():
    e, library = WordEncoder(WORD), Tokenizer.from_file(WORD)
    for w in ["It's.", "a.b.", "x'.", "É.", "don't,", "ΑΣ.", "...", "a..", "x y.", "1.", "<|endoftext|>.", "\x1c q", "ﬁ.", "K."]:
        assert e.encode([w])[0].tolist() == library.encode(w, add_special_tokens=False).ids


def test_empty_tables_and_clashing_columns(nothing, odd, clashing):
    for f in (lambda d: bpe.round_trip(d, MULTI, P.PATTERN), lambda d: attribution.token_counts(d, PLAIN, P.PATTERN), lambda d: packing.pack(d, WORD)):
        assert f(nothing).count() == 0
        assert table_of(f(clashing).select(f(odd).columns)) == table_of(f(odd))


def test_words_of_letters_are_encoded_together_as_one_by_one():
    import random
    rng = random.Random(12)
    e, library = WordEncoder(WORD), Tokenizer.from_file(WORD)
    words = ["".join(rng.choices("etaoinshrdluETAKLxéÉßñüÜŁĳŉǆ", k=rng.randint(1, 14))) for _ in range(3000)] + ["s", "t", "re", "ll", "d", "w", "I", "a" * 300]
    words += [f"a{chr(c)}b" for c in range(0xC0, 0x250) if e._letters.fullmatch(chr(c))]
    words = list(dict.fromkeys(words))
    assert [np.frombuffer(ids, dtype=np.uint32).tolist() for ids in e._ids_of_letters(words)] == [
        library.encode(w, add_special_tokens=False).ids for w in words]
    mixed = ["a", "b-c", "İx", "1"]  # not one piece each: encoded one by one
    assert [np.frombuffer(ids, dtype=np.uint32).tolist() for ids in e._ids_of_letters(mixed)] == [library.encode(w, add_special_tokens=False).ids for w in mixed]
    text = " ".join(w + rng.choice(["", "", ".", ",", "'s", "!", "é"]) for w in words)
    assert e.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_and_their_stems_are_encoded_as_the_library_does():
    """Ends after letters, digits, other ends and nothing; capitals; words beside texts that hold a separator; and again from the cache."""
    e, library = WordEncoder(WORD), Tokenizer.from_file(WORD)
    texts = ["End. END, end a. A, . , .. ,. a.. 1. 1, É. é, Éa, x\u0301. I. i,", "A. a A", " \n ", "\x1c a.\x1fB, ", "aA.Aa, aa,AA. \u1e9e. \u0130,"]
    for _ in range(2):
        assert [ids.tolist() for ids in e.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert not e.known.missed and not e.known.gaps


def test_special_strings_in_texts_are_encoded_as_the_library_does():
    """Against the unmodified tokenizer, in every surrounding, and after the cache has been emptied."""
    e, library = WordEncoder(WORD), Tokenizer.from_file(WORD)
    a, b = "<|startoftext|>", "<|endoftext|>"
    texts = [f"end {b} start", f"end{b}start", f"{b}{a}", b, f"x.{a}.", f"{a} {b}\n{a}", f"<|ENDOFTEXT|> {b[:-1]}", f"<{b}>", f"<|{b}|>", f"é{b}\x1cÉ, {a}\x1f"]
    for _ in range(2):
        assert [ids.tolist() for ids in e.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        e.known.keep_half(8)
