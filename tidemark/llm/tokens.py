"""Token ids of whole texts, with each distinct chunk of text encoded once.

A vocabulary splits a text into pieces before it merges bytes, and no piece
crosses certain places; the text between two such places ("chunk") is encoded
by the `tokenizers` library once per worker and kept as bytes of little-endian
32-bit ids, so that a text's ids are the chunks' ids joined. The results are
those of encoding the text at once. Runs of Latin letters need no splitting and go
straight to the library's merges; what follows them in a chunk is looked up by itself.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

from tidemark.llm.common import CACHE_ENTRIES

ID_BYTES = 4
# A piece may take one space before a word and none after it: the place before
# a space that a printable ASCII character follows is never inside a piece.
_SAFE_SPACE = re.compile(rb" (?=[!-~])")
# Nor does a piece go on from an ASCII letter to another ASCII character, or
# past a line break between two printable characters.
_INNER = re.compile(rb"(?<=[A-Za-z])(?=[\t-\r!-@\[-`{-~])|(?<=[!-~]\n)(?=[!-~])")

# A run of ASCII and Latin-1 letters: a single piece in these vocabularies, which also
# ends before an ASCII character that is no letter.
_LETTERS = re.compile(rb"[A-Za-z]*(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][A-Za-z]*)*")


def _byte_symbols() -> dict[int, int]:
    """Byte-level vocabularies write a byte as the character of its number if that is
    visible in Latin-1, and number the other bytes from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + i for i, b in enumerate(hidden)}


_SYMBOLS = _byte_symbols()


def load(vocabulary: str):
    """The tokenizer of a file; strings of special tokens in texts are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    return tokenizer


class _Chunks(dict):
    """Ids of chunks behind a fixed prefix.

    The first CACHE_ENTRIES chunks met are kept. Chunks of several pieces, which cost
    little once their first piece is known, may take half of these places.
    """

    def __init__(
        self,
        tokenizer,
        prefix: bytes = b"",
        tails: _Chunks | None = None,
        lower: bool = False,
    ):
        super().__init__()
        self.tokenizer, self.merges = tokenizer, tokenizer.model.tokenize
        self.prefix, self.lower = prefix, lower
        self.symbols = prefix.decode().translate(_SYMBOLS)
        self.tails = self if tails is None else tails

    def __missing__(self, chunk: bytes) -> bytes:
        places = CACHE_ENTRIES
        if chunk.isalpha():  # ASCII letters, which are symbols as they are
            letters = chunk.decode()
            value = self._merged(self.symbols + (letters.lower() if self.lower else letters))
        else:
            end = _LETTERS.match(chunk).end()
            if end == len(chunk) > 0:
                letters = chunk.decode()
                data = (letters.lower() if self.lower else letters).encode()
                value = self._merged((self.prefix + data).decode("latin-1").translate(_SYMBOLS))
            elif end and chunk[end] < 0x80:
                places //= 2
                value = self[chunk[:end]] + self.tails[chunk[end:]]
            else:
                places //= 2
                value = self._split(chunk)
        if len(self) < places and len(chunk) <= 64:
            self[chunk] = value
        return value

    def _merged(self, symbols: str) -> bytes:
        return _packed([token.id for token in self.merges(symbols)])

    def _split(self, chunk: bytes) -> bytes:
        if self.prefix and not chunk[:1].strip():
            raise ValueError("white space next to the space")
        parts = _INNER.split(chunk)
        if len(parts) > 1:
            return self[parts[0]] + b"".join(map(self.tails.__getitem__, parts[1:]))
        text = (self.prefix + chunk).decode("utf-8", "replace")
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _packed(ids: list[int]) -> bytes:
    values = array("I", ids)
    if sys.byteorder == "big":
        values.byteswap()
    return values.tobytes()


class SpacePrefixed:
    """Byte-level vocabularies in which a space belongs to the word after it."""

    def __init__(self, tokenizer):
        self.head = _Chunks(tokenizer)
        self.spaced = _Chunks(tokenizer, b" ", self.head)

    def encode(self, text: bytes) -> bytes:
        chunks = text.split(b" ")
        try:
            rest = b"".join(map(self.spaced.__getitem__, chunks[1:]))
        except ValueError:  # runs of white space: split at safe places only
            chunks = _SAFE_SPACE.split(text)
            rest = b"".join(map(self.spaced.__getitem__, chunks[1:]))
        return self.head[chunks[0]] + rest


class SpaceFree:
    """Vocabularies that drop white space and lower-case the text."""

    def __init__(self, tokenizer):
        self.words = _Chunks(tokenizer, lower=True)

    def encode(self, text: bytes) -> bytes:
        # Lower-casing first finds more chunks known; only in plain ASCII does
        # it surely commute with the vocabulary's own normalisation.
        if text.isascii():
            text = text.lower()
        return b"".join(map(self.words.__getitem__, text.split()))


_encoders: dict[tuple[str, type], SpacePrefixed | SpaceFree] = {}


def encoder(vocabulary: str, kind: type) -> SpacePrefixed | SpaceFree:
    """One encoder per worker, vocabulary file and kind."""
    if (vocabulary, kind) not in _encoders:
        _encoders[vocabulary, kind] = kind(load(vocabulary))
    return _encoders[vocabulary, kind]
