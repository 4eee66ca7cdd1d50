"""Tokenizing through a memo of words.

For a tokenizer that drops white space and never lets a token or a
normalization span it (``word_bpe_49k.json``), the ids of a text are the ids of
its white-space separated words laid end to end.  Words repeat, so each worker
keeps their ids; the library sees every word once while the memo holds it.  A word of
Latin letters alone is one pre-token and goes straight to the library's merge model.
"""

from __future__ import annotations

import re
import string
import sys
from array import array

import numpy as np
from tokenizers import Tokenizer

# Punctuation that the pre-tokenizer separates from a letter or digit before it (the apostrophe joins endings to words).
TAIL = bytes(ord(c) for c in string.punctuation if c != "'")


#: ASCII and accented Latin-1 letters, in UTF-8.
LETTERS = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
_LETTER_RUN = re.compile(LETTERS + rb"+")
#: What an entry of a memo takes beside the bytes of its key and value, about.
ENTRY = 170


def ends_in_letter_or_digit(word: bytes) -> bool:
    """ASCII and accented Latin-1 (a false answer is always safe)."""
    return word[-1:].isalnum() or (word[-2:-1] == b"\xc3" and word[-1] not in (0x97, 0xB7))


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: visible Latin-1 bytes
    stand for themselves, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


BYTE_OF = _byte_letters()
SPELLED = {b: c for c, b in BYTE_OF.items()}


def merged(model, raw: bytes) -> bytes:
    """Ids (little-endian 32-bit) of one pre-token by a byte-level model."""
    if raw.isalpha():  # ASCII letters stand for themselves
        spelled = raw.decode()
    elif raw[:1] == b" " and raw[1:].isalpha():
        spelled = SPELLED[32] + raw[1:].decode()
    else:
        spelled = raw.decode("latin-1").translate(SPELLED)
    return packed([t.id for t in model.tokenize(spelled)])


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Memo(dict):
    """A dict of bytes that fills itself, in two generations: beyond ``limit`` bytes the younger one becomes the older, whose entries
    move back when they are asked for, so what is in use stays.  Keys longer than ``longest`` bytes are not kept."""

    def __init__(self, make, limit: int, longest: int = 256):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest
        self.held, self.old = 0, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) > self.longest:
            return value
        if self.held > self.limit:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += len(key) + len(value) + ENTRY
        self[key] = value
        return value


class WordIds:
    """``encode(utf8) -> uint32 ids`` with a memo of at most ``limit`` bytes in each of two generations."""

    def __init__(self, path: str, limit: int):
        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        self.marks = [t.content.encode() for t in self.full.get_added_tokens_decoder().values()]
        probe = "The é, 12 d'un x École, naïveté"
        apart = [i for w in probe.split() for i in self._library(w.encode())]
        if self._library(probe.encode()) != apart or self._library(b"THE") != self._library(b"the"):
            raise ValueError(f"{path}: ids depend on white space or case; the word memo does not apply")
        self.words = Memo(self._word, limit)
        if any(self._word(w.encode().lower()) != packed(self._library(w.encode())) for w in probe.split()):
            raise ValueError(f"{path}: not a byte-level vocabulary")

    def _library(self, text: bytes) -> list[int]:
        return self.full.encode(text.decode(), add_special_tokens=False).ids

    def _word(self, word: bytes) -> bytes:
        if _LETTER_RUN.fullmatch(word):  # one pre-token; the normalizer changes nothing but case
            return merged(self.full.model, word.decode().lower().encode())
        core = word.rstrip(TAIL)
        if core != word and ends_in_letter_or_digit(core):
            return self.words[core] + self.words[word[len(core):]]
        return packed(self._library(word))

    def encode(self, text: bytes) -> np.ndarray:
        if any(m in text.lower() for m in self.marks):  # a special token's string: left to the library
            return np.array(self._library(text), np.uint32)
        return np.frombuffer(b"".join(map(self.words.__getitem__, text.lower().split())), np.uint32)


_KEPT: dict[tuple, WordIds] = {}


def word_ids(path: str, limit: int) -> WordIds:
    """The worker's tokenizer: it and its memos outlive a task."""
    if (path, limit) not in _KEPT:
        _KEPT[path, limit] = WordIds(path, limit)
    return _KEPT[path, limit]
