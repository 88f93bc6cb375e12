"""Token ids of the public word-level BPE vocabulary, by the ``tokenizers`` library, remembered by word.

The vocabulary ends words, drops white space and never merges across it, so the ids of a text are those of its
chunks between white space.  Chunks and words are remembered in two bounded dictionaries of a worker;
only what is new goes to the library.  Texts that the rule does not cover (special tokens,
white space on which Python and the library differ) go to the library whole.
"""

from __future__ import annotations

import re
import sys
from array import array
from functools import lru_cache

REMEMBERED = 250_000
_SWAP = sys.byteorder == "big"
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-įı-ſ]+")
# Fixed value: the vocabulary's own split into words, over plain characters
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_WHOLE = re.compile("[\x1c-\x1f]|<\\|(?:start|end)oftext\\|>")


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as itself where it prints, else as the next free code point."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in prints]
    return {b: 256 + i for i, b in enumerate(rest)}


class _Remembered(dict):
    """Values by key, made when missing.  A full dictionary becomes the old one, from which what is used again returns."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordTokens:
    """``encode(text)``: the ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.words = _Remembered(self._word)
        self.chunks = _Remembered(self._chunk)

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return _pack([t.id for t in self.model.tokenize(word)])

    def _chunk(self, chunk: str) -> bytes:
        words = self.words
        if chunk.isascii():                        # the common cases: a word, or a word and a mark
            if chunk.isalpha():
                return words[chunk.lower()]
            if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
                return words[chunk[:-1].lower()] + words[chunk[-1]]
        if _PLAIN.fullmatch(chunk):
            return b"".join([words[w] for w in _WORDS.findall(chunk.lower())])
        return _pack(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if _WHOLE.search(text):
            return _pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if text.isascii():
            text = text.lower()
        return b"".join(map(self.chunks.__getitem__, text.split()))


def _pack(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if _SWAP:
        packed.byteswap()
    return packed.tobytes()


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One instance a worker process: what it remembers serves all of the worker's tasks."""
    return WordTokens(path)


def public_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
