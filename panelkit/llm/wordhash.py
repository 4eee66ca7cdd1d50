"""Hashes of words and word windows, and packed (key, document) exchanges.

Word sequences of many documents are handled as one long array of 64-bit word
hashes plus the documents' lengths.  Key lists are moved between tasks as packed
blobs, one row per (destination, group of documents), because a row of its own
for each of billions of 8-byte keys would cost several times the key.
"""

from __future__ import annotations

import numpy as np
import zstandard
from xxhash import xxh3_64_intdigest

U = np.uint64
LAST = np.iinfo(np.int64).max


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finalizer (the splitmix constants)."""
    z = x + U((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> U(30))) * U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> U(27))) * U(0x94D049BB133111EB)
    return z ^ (z >> U(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of k consecutive entries of ``h`` (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    w = mix(h, salt)
    out = w[:n].copy()
    for j in range(1, k):
        out *= U(0x9FB21C651E98DF25)
        out += w[j:j + n]
    return mix(out, salt + 1)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """First index of each document in the joined array (and the end)."""
    return np.concatenate([[0], np.cumsum(lengths)])


class Flush:
    """Gathers documents until they hold ``limit`` words."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self):
        self.docs, self.tags, self.hashes, self.extra, self.n = [], [], [], [], 0

    def add(self, doc: int, tag: int, words: list[bytes], extra=None) -> bool:
        """Take a document; True when it is time to flush."""
        self.docs.append(doc)
        self.tags.append(tag)
        self.hashes.append(word_hashes(words))
        self.extra.append(extra)
        self.n += len(words)
        return self.n >= self.limit

    def arrays(self):
        """doc ids, tags, joined hashes, document starts."""
        h = np.concatenate(self.hashes) if self.hashes else np.zeros(0, np.uint64)
        return (np.array(self.docs, np.int64), np.array(self.tags, np.int64), h,
                starts_of(np.array([len(x) for x in self.hashes], np.int64)))


def pack(*cols: np.ndarray) -> bytes:
    """Columns of equal length as one blob.  The first one is sent as differences, so sort by it."""
    if not len(cols[0]):
        return b""
    first = np.diff(cols[0], prepend=cols[0].dtype.type(0))
    raw = len(first).to_bytes(8, "little") + first.tobytes() + b"".join(np.ascontiguousarray(c).tobytes() for c in cols[1:])
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(blob: bytes, *types) -> list[np.ndarray]:
    """Inverse of ``pack``; a type like ("u1", 5) is a column of 5-byte rows."""
    kinds = [np.dtype(t) if not isinstance(t, tuple) else np.dtype((t[0], (t[1],))) for t in types]
    if not blob:
        return [np.zeros((0, *k.shape), k.base) for k in kinds]
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for k in kinds:
        out.append(np.frombuffer(raw, k.base, n * int(np.prod(k.shape, dtype=int)), at).reshape(n, *k.shape))
        at += n * k.itemsize
    out[0] = np.cumsum(out[0], dtype=out[0].dtype)
    return out


def unpack_all(blobs: list[bytes], *types) -> list[np.ndarray]:
    parts = [unpack(b, *types) for b in blobs if b] or [unpack(b"", *types)]
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def to5(keys: np.ndarray) -> np.ndarray:
    """The low five bytes of each key."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def from5(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").reshape(-1)


def split_by(dest: np.ndarray, n: int):
    """(destination, indices) for each destination that occurs, given entries in any order; order is kept within one."""
    order = np.argsort(dest, kind="stable")
    cuts = np.searchsorted(dest[order], np.arange(n + 1))
    for d in np.flatnonzero(np.diff(cuts)):
        yield int(d), order[cuts[d]:cuts[d + 1]]


def home(docs: np.ndarray, n: int) -> np.ndarray:
    """The destination of a document's own results."""
    return (mix(docs.astype(np.uint64), 11) % U(n)).astype(np.int64)
