"""Ids of the lower-casing word vocabulary, one distinct word at a time.

The tokenizer drops white space and splits at it first, so the ids of a text are those of its
white-space-separated words in order, and the ids of a word those of its pieces (letter runs, single
digits, other runs).  Each worker keeps the ids of the words and pieces it has met, up to a bound,
then starts anew, and gives only new pieces to the ``tokenizers`` library.
"""

from __future__ import annotations

import os
from functools import cached_property, lru_cache
from itertools import compress, islice
from operator import not_

import numpy as np
import regex

# Unicode White_Space, as the vocabulary's own patterns see it (str.split would add U+001C to U+001F).
_ODD = regex.compile("[\x1c-\x1f]")
_WORDS = regex.compile(r"\S+")
# Fixed value: the split pattern of the vocabulary file, after white space is gone.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+|\n")  # and newlines, which mark words here
#: Words beyond these letters go through the library's own normaliser.
_PLAIN_BELOW = "ɐ"
KNOWN_WORDS = 800_000  # and as many pieces
_AT_ONCE = 500


class WordTokens:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._path = path
        self._pieces = Tokenizer.from_file(path)  # for pieces: lower case already, split at spaces only
        self._pieces.encode_special_tokens = True
        self._pieces.normalizer = normalizers.Sequence([])
        self._pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ends = [i for token, i in self._pieces.get_vocab().items() if token.endswith("</w>")]
        self._ends = np.zeros(self._pieces.get_vocab_size() + 1, dtype=bool)
        self._ends[ends] = True
        self._words: dict[str, bytes] = {}
        self._known: dict[str, bytes] = {}

    @cached_property
    def _whole(self):
        """The library with its own normaliser; most corpora never need it."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self._path)
        library.encode_special_tokens = True  # their strings in a text are ordinary text
        return library

    def _learn_pieces(self, pieces: list[str]) -> None:
        each = iter(pieces)
        while group := list(islice(each, _AT_ONCE)):
            ids = np.array(self._pieces.encode(" ".join(group), add_special_tokens=False).ids, dtype="<u4")
            ends = (np.flatnonzero(self._ends[ids]) + 1).tolist()
            if len(ends) != len(group):
                raise RuntimeError("a piece does not end in exactly one end-of-word token")
            raw, begin = ids.tobytes(), 0
            for piece, end in zip(group, ends):
                self._known[piece] = raw[4 * begin:4 * end]
                begin = end

    def _learn_words(self, words: list[str]) -> None:
        joined = "\n".join(words)  # words hold no white space
        if max(joined) >= _PLAIN_BELOW:
            for w in words:
                if max(w) >= _PLAIN_BELOW:
                    self._words[w] = np.array(self._whole.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes()
            words = [w for w in words if max(w) < _PLAIN_BELOW]
            joined = "\n".join(words)
        if not words:
            return
        lower = joined.lower().split("\n")
        alone = list(map(str.isalpha, lower))  # a word of letters is one piece
        mixed = [x for x, one in zip(lower, alone) if not one]
        parts = _PIECES.findall("\n".join([*mixed, ""]))
        found = set(parts)
        found.update(compress(lower, alone))
        found.discard("\n")
        self._learn_pieces([p for p in found if p not in self._known])
        get = self._known.__getitem__
        # The pieces of all mixed words in one go, cut where the newlines stood.
        ids = map(get, compress(lower, alone))
        self._words.update(zip(compress(words, alone), ids))
        rest = iter(parts)
        for w in compress(words, map(not_, alone)):
            self._words[w] = b"".join(map(get, iter(rest.__next__, "\n")))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self._words) > KNOWN_WORDS:
            self._words.clear()
        if len(self._known) > KNOWN_WORDS:
            self._known.clear()
        split = [_WORDS.findall(t) if _ODD.search(t) else t.split() for t in texts]
        new: set[str] = set()
        for words in split:
            new.update(words)
        if new := [w for w in new if w not in self._words]:
            self._learn_words(new)
        get = self._words.__getitem__
        return [b"".join(map(get, words)) for words in split]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)
