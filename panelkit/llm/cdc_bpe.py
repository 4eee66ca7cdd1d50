"""BPE encoding with reuse of content-defined chunks, and decoding.

Chunks: a rolling hash of the last eight bytes decides where a text is cut (at code point borders only, about every
``2 ** bits`` bytes), so copied passages are cut alike wherever they stand.  A chunk's *core* runs from its first
to its last safe place: a visible ASCII or accented Latin-1 character before ASCII white space, where byte-level pre-tokenization
always splits.  The ids of a core depend on its bytes alone and are encoded once and reused.

Joins: between two cores lies a join (the end of one chunk, the start of the next, and whole chunks without a safe place).
It is encoded on its own, then the tokenizer encodes it again with one more piece on either side; if these wider ids are not the
pieces' and the join's ids end to end, the join is widened by those pieces and the neighbouring cores are cut back, until both agree
or the text's ends are reached.  The result equals encoding the whole text.

Within a core or a join the library sees each *piece* (white space and the visible run after it) once while a worker's
second memo holds it; text with unusual white space, control characters or special tokens' strings goes to the library as it is.

Routing: documents that share chunks should meet.  Each goes to the task of its least chunk hash, and documents
lie sorted by that hash in a task, so a chunk is encoded once where its documents meet and is
forgotten when the memo is full (``memo_bytes``).  A hash shared by more than half a task's documents is dealt over several tasks:
the table of such hashes, at most two a shuffle partition, is broadcast.

Scale: the texts are shuffled once, and no ids are.  A task holds one Arrow batch and two memos bounded in bytes.

Defined cases: null text is empty and has no ids; a special token's string in a text gets the special id, as the
library does it (it has no white space in it, so no cut divides it for good); texts without any
safe place are encoded whole, very long texts chunk by chunk in time that grows with their length; repeated rows give equal results; an empty table gives an empty result; a null
doc_id is kept; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm import common as C
from panelkit.llm.wordcache import BYTE_OF, LETTERS, TAIL, Memo, ends_in_letter_or_digit, merged, packed

WINDOW = 8
FACTOR = np.uint64(0x9FB21C651E98DF25)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True
_SEEN = np.zeros(256, bool)
_SEEN[33:127] = True
#: Pieces: white space and what follows it.  Their borders are safe places.
_PIECE = re.compile(rb"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: A space or none and a run of ASCII and accented Latin-1 letters.
_LETTER_RUN = re.compile(rb" ?" + LETTERS + rb"+")
#: What keeps a text from being split into pieces: other white space, control characters, the start of a special token.
_ODD = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]|\xc2[\x80-\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_ENCODERS: dict[tuple, "ChunkEncoder"] = {}

ROUTE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("route", T.LongType())])
ENCODED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    T.StructField("chunks", T.LongType()), T.StructField("encoded_chunks", T.LongType())])


def cuts(raw: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunk borders of a text (both ends included), and the rolling hashes there (inner borders)."""
    n = len(raw)
    if n <= WINDOW:
        return np.array([0, n], np.int64), np.zeros(0, np.uint64)
    windows = np.lib.stride_tricks.as_strided(raw, (n - WINDOW, WINDOW), (1, 1))
    h = np.ascontiguousarray(windows).view("<u8").reshape(-1) * FACTOR
    at = np.flatnonzero((h >> np.uint64(64 - bits)) == 0) + WINDOW  # the place after the window
    at = at[(raw[at] & 0xC0) != 0x80]
    return np.concatenate([[0], at, [n]]), h[at - WINDOW]


def route_of(text: bytes, bits: int) -> int:
    """Hash of the least of a text's border hashes (of the text itself if it is not cut)."""
    raw = np.frombuffer(text, np.uint8)
    _, h = cuts(raw, bits)
    if len(h):
        return int((h.min(keepdims=True) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)[0])
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _token_bytes(token: str) -> bytes:
    return bytes(BYTE_OF[c] for c in token) if all(c in BYTE_OF for c in token) else token.encode()


class ChunkEncoder:
    def __init__(self, path: str, bits: int, memo_bytes: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if any(t.lstrip or t.rstrip or t.normalized or any(c.isspace() for c in t.content)
               for t in self.tokenizer.get_added_tokens_decoder().values()) or self.tokenizer.normalizer is not None:
            raise ValueError(f"{path}: text around white space is not independent; chunks cannot be reused")
        for probe in (" naïve", "Écoles"):
            if merged(self.tokenizer.model, probe.encode()) != self._library(probe.encode()):
                raise ValueError(f"{path}: not a byte-level vocabulary")
        self.bits, self.limit = bits, memo_bytes
        self.marks = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = Memo(self._piece, memo_bytes)
        self.memo: dict[bytes, bytes] = {}
        n = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.bytes_of = [_token_bytes(self.tokenizer.id_to_token(i) or "") for i in range(n)]
        self.decimal = [str(i) for i in range(n)]
        self.plain = False  # the text in hand is known to be plain
        self.held = self.chunks = self.encoded = self.widened = 0

    def _library(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids if text else []
        return packed(ids)

    def _piece(self, piece: bytes) -> bytes:
        """Punctuation after a letter or digit is a pre-token of its own (but for the apostrophe, which joins endings)."""
        word = piece.rstrip(TAIL)
        if word != piece and ends_in_letter_or_digit(word):
            return self.pieces[word] + self.pieces[piece[len(word):]]
        if _LETTER_RUN.fullmatch(piece):  # one pre-token: straight to the library's merge model
            return merged(self.tokenizer.model, piece)
        return self._library(piece)

    def is_plain(self, text: bytes) -> bool:
        """White-space pieces of a plain text are independent; so are those of its parts."""
        return not _ODD.search(text) and not any(m in text for m in self.marks)

    def library(self, text: bytes) -> bytes:
        """Ids (little-endian 32-bit) of a text that starts and ends at safe places (or at the document's ends)."""
        if not self.plain and not self.is_plain(text):
            return self._library(text)
        return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text)))

    def core(self, chunk: bytes, first: int, last: int) -> bytes:
        """Ids of a chunk's core, which is chunk[first:last]."""
        self.chunks += 1
        ids = self.memo.get(chunk)
        if ids is None:
            self.encoded += 1
            ids = self.library(chunk[first:last])
            if self.held > self.limit:
                self.memo.clear()
                self.held = 0
            self.memo[chunk] = ids
            self.held += len(chunk) + len(ids) + 200
        return ids

    def join(self, text: bytes, safe: np.ndarray, a: int, b: int, low: int, high: int) -> tuple[int, int, bytes]:
        """Ids of the join between safe[a] and safe[b] (indices), widened until the tokenizer's own encoding of the wider span
        agrees with the parts; ``low`` and ``high`` bound how far.  Returns the places reached and the ids."""
        ids = self.library(text[safe[a]:safe[b]])
        while True:
            wide_a, wide_b = max(a - 1, low), min(b + 1, high)
            if (wide_a, wide_b) == (a, b):
                return a, b, ids
            wide = self._library(text[safe[wide_a]:safe[wide_b]])
            if wide == self.library(text[safe[wide_a]:safe[a]]) + ids + self.library(text[safe[b]:safe[wide_b]]):
                return a, b, ids
            self.widened += 1
            a, b, ids = wide_a, wide_b, wide

    def decode(self, ids: list[int]) -> str:
        """The tokens' bytes end to end; what is no UTF-8 becomes U+FFFD, as the library does it."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def encode(self, text: bytes) -> bytes:
        """Ids (little-endian 32-bit) of a whole text."""
        self.plain = self.is_plain(text)
        raw = np.frombuffer(text, np.uint8)
        borders, _ = cuts(raw, self.bits)
        if len(borders) == 2:
            return self.library(text)
        seen = _SEEN[raw[:-1]]
        seen[1:] |= (raw[:-2] == 0xC3) & (raw[1:-1] >= 0x80)  # U+00C0 to U+00FF: no white space among them
        inner = np.flatnonzero(seen & _SPACE[raw[1:]]) + 1
        safe = np.concatenate([[0], inner, [len(raw)]])
        first = np.searchsorted(safe, borders[:-1], side="right")     # first safe place inside each chunk
        last = np.searchsorted(safe, borders[1:], side="left") - 1    # last one
        cores = [(int(c), int(f), int(g)) for c, (f, g) in enumerate(zip(first, last, strict=True)) if g > f]
        out: list[bytes] = []
        done = floor = 0  # indices of safe places: up to done the text is encoded, back to floor a join may widen
        end = len(safe) - 1
        for i, (c, f, g) in enumerate(cores):
            start = int(borders[c])
            ids = self.core(text[start:int(borders[c + 1])], int(safe[f]) - start, int(safe[g]) - start)
            # the join reaches back to what is done and on into this core at most
            a, b, between = self.join(text, safe, done, f, floor, g) if f > done else (done, f, b"")
            if a != done:  # the core before, which lies from floor to done, was cut back
                out[-1] = self.library(text[safe[floor]:safe[a]])
            out += [between, ids if b == f else self.library(text[safe[b]:safe[g]])]
            floor = b
            done = g
        if done < end:
            a, _, between = self.join(text, safe, done, end, floor, end)
            if a != done:
                out[-1] = self.library(text[safe[floor]:safe[a]])
            out.append(between)
        return b"".join(out)


def encoder(path: str, bits: int, memo_bytes: int) -> ChunkEncoder:
    """The worker's encoder: it and its memo outlive a task."""
    key = (path, bits, memo_bytes)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, bits, memo_bytes)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, tokenizer: str, bits: int = 9, memo_bytes: int = 96 << 20, with_ids: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids (little-endian 32-bit; null unless ``with_ids``), ids_sha256 (of the decimal ids
    joined by commas), decoded_sha256 (of the decoded text), and how many chunks it has and how many of them were encoded for it."""
    spark = docs.sparkSession
    C.ship(spark)
    n = C.partitions(spark)
    routed_schema, out = C.arrow(ROUTE), C.arrow(ENCODED)

    def route(batches):
        for b in batches:
            yield C.batch(routed_schema, doc_id=b.column("doc_id"), text=b.column("text").cast("string"),
                          route=[route_of(t, bits) for t in C.payloads(b, "text")])

    def encode(batches):
        enc = encoder(tokenizer, bits, memo_bytes)
        for b in batches:
            rows = {f.name: [] for f in out}
            for text in C.payloads(b, "text"):
                before, new = enc.chunks, enc.encoded
                packed = enc.encode(text)
                ids = np.frombuffer(packed, "<u4").tolist()
                rows["n_tokens"].append(len(ids))
                rows["ids"].append(packed if with_ids else None)
                rows["ids_sha256"].append(hashlib.sha256(",".join(map(enc.decimal.__getitem__, ids)).encode()).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(enc.decode(ids).encode()).hexdigest())
                rows["chunks"].append(enc.chunks - before)
                rows["encoded_chunks"].append(enc.encoded - new)
            yield C.batch(out, **(rows | {"doc_id": b.column("doc_id")}))

    routed = C.texts(docs).mapInArrow(route, ROUTE)
    counts = C.saved(routed.groupBy("route").agg(F.count(F.lit(1)).alias("n")), "routes")
    share = max(1, (counts.agg(F.sum("n")).first()[0] or 0) // (2 * n))  # half a task's documents
    # at most 2 n hashes are that frequent: a table of that bound is broadcast
    hot = C.saved(counts.where(F.col("n") > share).select("route", F.ceil(F.col("n") / share).cast("long").alias("parts")), "hot-routes")
    deal = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(0)).cast("int")
    dealt = routed.join(F.broadcast(hot), "route", "left").withColumn("deal", deal).repartition(n, "route", "deal").sortWithinPartitions("route")
    return dealt.select("doc_id", "text").mapInArrow(encode, ENCODED)
