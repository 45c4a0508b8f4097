"""Public tokenizers inside Python tasks. Vocabulary files are read where they lie; nothing is trained or copied."""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np

#: Words kept in a worker's memory; when there are more, the first half, which holds the frequent ones, stays (a
#: memory bound; results don't depend on it).
CACHE_WORDS = 450_000

#: Words of letters that the tokenizer gets as one text.
LETTERS_AT_ONCE = 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str):
    """A tiktoken encoder without special tokens, and the byte length of each id."""
    import tiktoken

    ranks = read_ranks(path)
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


class Known(dict):
    """Ids by word or piece; those asked for in vain are noted, in order, until their ids are filled in."""

    def __init__(self, *given):
        super().__init__(*given)
        self.missed: list = []
        self.gaps: list[tuple[list, int, int]] = []

    def __missing__(self, key) -> None:
        self.missed.append(key)

    def find(self, keys: Iterable) -> list:
        """The ids of each key; None, until ``fill``, where one isn't known. The keys themselves needn't be held."""
        before = len(self.missed)
        found = list(map(self.__getitem__, keys))
        if len(self.missed) > before:
            self.gaps.append((found, before, len(self.missed)))
        return found

    def fill(self, ids: dict) -> None:
        """Put the ids of the keys that were missed into what ``find`` gave."""
        missed, gaps, self.missed, self.gaps = self.missed, self.gaps, [], []
        for found, a, b in gaps:
            at = -1
            for key in missed[a:b]:
                at = found.index(None, at + 1)
                found[at] = ids[key]

    def keep_half(self, most: int) -> None:
        """Beyond so many, keep the first half of them, which holds the frequent ones."""
        if len(self) > most:
            half = list(islice(self.items(), most // 2))
            self.clear()
            self.update(half)


class WordEncoder:
    """Ids of the white-space-dropping word BPE, found once for each distinct word.

    The tokenizer drops white space and never merges across it, so a text's ids are those of
    its words in order. Python also splits at the separators U+001C to U+001F, which are no white
    space to the tokenizer; texts that hold one are split at common white space only.
    A full stop or comma after an ASCII letter is always a token of its own, and the tokenizer lowers
    letters, so such words are looked up by their stem in lower case.
    The strings of the tokenizer's special tokens become their ids wherever they stand, as the library has it.
    """

    _split = re.compile("[ \t\n\r]+")
    _odd = "\x1c\x1d\x1e\x1f"
    #: Latin letters that lowering and composing leave single letters.
    _letters = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {token.content: i for i, token in self.tokenizer.get_added_tokens_decoder().items()}
        self._contents = list(special)
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.tokenizer.encode_special_tokens = True  # words hold none, but may after lowering
        # special tokens are kept under tuples, so that no word can meet them
        self.known = Known({(content,): array("I", [i]).tobytes() for content, i in special.items()})
        self.ends = dict(zip(".,", self._ids([".", ","])))
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends_word[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def _ids(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def _ids_of_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of Latin letters alone, many at a call: each is one piece, and its last token alone ends a word.

        A word always has one end at least, so if there are as many ends as words, each has its own; else they are encoded one by one."""
        texts = [" ".join(words[k:k + LETTERS_AT_ONCE]) for k in range(0, len(words), LETTERS_AT_ONCE)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(f.ids, dtype=np.uint32) for f in found])
        data, bounds = ids.tobytes(), [0, *((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()]
        if len(bounds) != len(words) + 1:
            return self._ids(words)
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def _learn(self, words: set[str]) -> None:
        known, ends = self.known, self.ends
        stems: dict[str, str] = {}  # of the words that aren't their own
        new: set[str] = set()
        for word in words:
            stem = word[:-1] if word[-1:] in ends and word[-2:-1].isalpha() and word[-2].isascii() else word
            if stem.isascii():
                stem = stem.lower()
            if stem != word:
                stems[word] = stem
            if stem not in known:
                new.add(stem)
        letters = [stem for stem in new if self._letters.fullmatch(stem)]
        others = list(new.difference(letters))
        self.known.update(zip(others, self._ids(others)))
        if letters:
            self.known.update(zip(letters, self._ids_of_letters(letters)))
        for word, stem in stems.items():
            ids = known[stem]
            known[word] = ids + ends[word[-1]] if len(word) > len(stem) else ids

    def words(self, text: str) -> list[str | tuple]:
        if any(content in text for content in self._contents):
            parts = self._special.split(text)  # every second one a special token
            return [w for k, part in enumerate(parts) for w in ([(part,)] if k % 2 else self._words(part))]
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        return self._split.split(text) if any(c in text for c in self._odd) else text.split()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (uint32) of each text."""
        found = [self.known.find(self.words(text)) for text in texts]
        if self.known.missed:
            self._learn(set(self.known.missed))
            self.known.fill(self.known)
            self.known.keep_half(CACHE_WORDS)
        return [np.frombuffer(b"".join(ids), dtype=np.uint32) for ids in found]


def groups(rows: Iterable, weigh: Callable, most: int) -> Iterator[list]:
    """Lists of rows of bounded weight."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += weigh(row)
        if weight >= most:
            yield held
            held, weight = [], 0
    if held:
        yield held


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
