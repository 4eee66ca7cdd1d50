"""Removal of repeated passages by recompression.

A *window* is ``size`` consecutive words of one document.  A word goes if it lies in a
window whose word sequence also starts in a document with a smaller doc_id.

Naming rounds.  A document is a sequence of symbols, at first its words.  A round
splits the alphabet in two halves by a hash bit of the symbol's name and merges every
left-half symbol with a right-half symbol that follows it; the pair's name is a hash of the two
names, so equal pairs have one name everywhere, with no dictionary to agree on.  Whether two neighbours merge depends on
their names alone, so equal passages are cut alike but for symbols that touch their edges.
Equal neighbours lie in the same half and never merge: each member of a run of one word
stays a symbol, and a window inside a run holds as many borders as words (merged runs
would hide them).  Three rounds are made, the third only to symbols of at most six words; then

* a border between two symbols depends on the four words before and after it,
* borders are at most six words apart, so a window of 13 words holds one that has four words of the
  window on either side.

Spark round 1 therefore names each border by its eight words, and exchanges the names: a passage of 13 words or more that two
documents share shows up as a border name that both have.  A document with none is done.
Spark round 2 takes, for the others, the windows around shared borders and exchanges their full names (71 bits
and more: 64 and the number of the destination); a window is removed where another document with a smaller id has it.

Scale: names travel as packed blobs, grouped by name; documents handled together (``flush_words``) send each name once, with
the smallest document that has it, so a passage in a third of all documents sends one entry
per group of documents, not one per document.  Destinations grow with
``spark.sql.shuffle.partitions``.  The texts are shuffled once: both joins use one exchange by document.
No passage length, count or document length is capped.

Defined cases: null or empty text has no words and an empty kept text; texts under 13 words lose nothing;
rows repeated with one doc_id don't remove each other (no smaller id), rows of one doc_id with other texts are told
apart by a 64-bit text hash; a null doc_id counts as larger than all others, and such rows are spread by that hash; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm import common as C
from panelkit.llm import wordhash as H

SIZE = 13  # words of a window
SIDE = 4   # words on either side that decide a border of the third round
LONGEST = 6  # words of a symbol of the third round

ROUTED = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("dest", T.IntegerType()),
                       T.StructField("one", T.BinaryType()), T.StructField("more", T.BinaryType())])
FOUND = T.StructType([T.StructField("dest", T.IntegerType()), T.StructField("blob", T.BinaryType())])
OF_DOC = T.StructType([T.StructField("id", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("blob", T.BinaryType())])
KEPT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                     T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.BinaryType()),
                     T.StructField("kept_sha256", T.StringType())])


def name_round(names: np.ndarray, lengths: np.ndarray, docs: np.ndarray, salt: int, longest: int | None = None):
    """One round of pair naming: names, lengths in words and documents of the new symbols."""
    if not len(names):
        return names, lengths, docs
    left = (H.mix(names, 100 + salt) >> H.U(63)) == 0
    pair = left[:-1] & ~left[1:] & (docs[:-1] == docs[1:])
    if longest is not None:
        pair &= lengths[:-1] + lengths[1:] <= longest
    merged = np.append(pair, False)  # the symbol and the next one become one
    first = ~np.insert(pair, 0, False)
    nxt = np.append(names[1:], H.U(0))
    size = lengths + np.where(merged, np.append(lengths[1:], 0), 0)
    named = np.where(merged, H.mix(H.mix(names, 200 + salt) * H.U(0x9FB21C651E98DF25) + nxt, 201 + salt), names)
    return named[first], size[first], docs[first]


def borders(h: np.ndarray, starts: np.ndarray):
    """Places (in the joined array) of third-round borders with SIDE words on either side, their documents
    (as indices) and their 64-bit names."""
    sizes = np.diff(starts)
    docs = np.repeat(np.arange(len(sizes)), sizes)
    names, lengths, owner = h, np.ones(len(h), np.int64), docs
    for salt, longest in ((1, None), (2, None), (3, LONGEST)):
        names, lengths, owner = name_round(names, lengths, owner, salt, longest)
    at = np.cumsum(lengths) - lengths
    inside = (at - starts[owner] >= SIDE) & (starts[owner + 1] - at >= SIDE)
    at, owner = at[inside], owner[inside]
    return at, owner, H.window_hashes(h, 2 * SIDE)[at - SIDE] if len(at) else np.zeros(0, np.uint64)


def dest_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys & H.U(0xFFFFFF)) % H.U(n)).astype(np.int64)


def home(ids: np.ndarray, tags: np.ndarray, n: int) -> np.ndarray:
    """The destination of a document's own results; texts without an id are spread by their hash."""
    return H.home(np.where(ids == H.LAST, tags, ids), n)


def _round1(n: int, flush_words: int):
    """Documents -> border names, to the name's destination (kind 0) or, if shared within the flush, to the document's (kind 1)."""
    schema = C.arrow(ROUTED)

    def emit(f: H.Flush):
        ids, tags, h, starts = f.arrays()
        f.clear()
        _, owner, key = borders(h, starts)
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        fresh = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])) if len(key) else np.zeros(0, bool)
        key, owner = key[fresh], owner[fresh]
        first = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
        alone = first & np.append(first[1:], True) if len(key) else first
        short = key >> H.U(24)
        kind, dest, one, more = [], [], [], []
        for d, i in H.split_by(dest_of(key[first], n), n):
            i = np.flatnonzero(first)[i]
            lone, known = i[alone[i]], i[~alone[i]]
            lone = lone[np.argsort(ids[owner[lone]], kind="stable")]
            kind.append(0)
            dest.append(d)
            one.append(H.pack(ids[owner[lone]], tags[owner[lone]], H.to5(short[lone])))
            more.append(H.pack(np.sort(short[known])))
        shared = np.flatnonzero(~alone)
        for d, i in H.split_by(home(ids[owner[shared]], tags[owner[shared]], n), n):
            i = shared[i]
            i = i[np.argsort(ids[owner[i]], kind="stable")]
            kind.append(1)
            dest.append(d)
            one.append(H.pack(ids[owner[i]], tags[owner[i]], H.to5(short[i])))
            more.append(b"")
        return C.batch(schema, kind=kind, dest=dest, one=one, more=more)

    def run(batches):
        f = H.Flush(flush_words)
        for b in batches:
            for doc, tag, text in zip(b.column("id").to_pylist(), b.column("tag").to_pylist(), C.payloads(b, "text"), strict=True):
                words = text.split()
                if len(words) >= SIZE and f.add(doc, tag, words):
                    yield emit(f)
        if f.n:
            yield emit(f)

    return run


def _meet1(n: int):
    """At a destination of names: the documents whose border names others have too."""
    import pyarrow as pa

    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows or table.column("kind")[0].as_py() == 1:
            return pa.table({"dest": table.column("dest"), "blob": table.column("one")})
        ids, tags, raw = H.unpack_all(table.column("one").to_pylist(), "<i8", "<i8", ("u1", 5))
        known, = H.unpack_all(table.column("more").to_pylist(), "<u8")
        key = H.from5(raw)
        value, back, count = np.unique(key, return_inverse=True, return_counts=True)
        hit = (count[back] > 1) | np.isin(value, known)[back]
        return _to_docs(ids[hit], n, tags[hit], raw[hit])

    return run


def _to_docs(ids, n, tags, *cols):
    import pyarrow as pa

    dest, blob = [], []
    for d, i in H.split_by(home(ids, tags, n), n):
        i = i[np.argsort(ids[i], kind="stable")]
        dest.append(d)
        blob.append(H.pack(ids[i], tags[i], *[c[i] for c in cols]))
    return pa.table({"dest": pa.array(dest, pa.int32()), "blob": pa.array(blob, pa.binary())})


def _of_doc(value):
    """At a destination of documents: one row per document, its values joined."""
    import pyarrow as pa

    def run(table: pa.Table) -> pa.Table:
        ids, tags, vals = H.unpack_all(table.column("blob").to_pylist(), "<i8", "<i8", value)
        order = np.lexsort((tags, ids))
        ids, tags, vals = ids[order], tags[order], vals[order]
        cut = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]))) if len(ids) else np.zeros(0, int)
        ends = np.append(cut[1:], len(ids))
        return pa.table({"id": pa.array(ids[cut], pa.int64()), "tag": pa.array(tags[cut], pa.int64()),
                         "blob": pa.array([np.ascontiguousarray(vals[a:b]).tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary())})

    return run


def _round2(n: int, flush_words: int):
    """Documents with shared border names -> names of the windows around them."""
    schema = C.arrow(ROUTED)

    def emit(f: H.Flush):
        ids, tags, h, starts = f.arrays()
        at, owner, key = borders(h, starts)
        short = key >> H.U(24)
        hit = np.zeros(len(at), bool)
        cuts = np.searchsorted(owner, np.arange(len(ids) + 1))
        for d, blob in enumerate(f.extra):
            a, b = cuts[d], cuts[d + 1]
            hit[a:b] = np.isin(short[a:b], H.from5(np.frombuffer(blob, np.uint8).reshape(-1, 5)))
        f.clear()
        at, owner = at[hit], owner[hit]
        # windows that hold the border with SIDE words on either side, within the document
        w = (at[:, None] - np.arange(SIDE, SIZE - SIDE + 1)[None, :]).ravel()
        o = np.repeat(owner, SIZE - 2 * SIDE + 1)
        w = np.unique(w[(w >= starts[o]) & (w + SIZE <= starts[o + 1])])
        o = np.searchsorted(starts, w, side="right") - 1
        full, pos = H.window_hashes(h, SIZE, 7)[w] if len(w) else np.zeros(0, np.uint64), (w - starts[o]).astype(np.uint32)
        order = np.lexsort((ids[o], full))
        full, o, pos = full[order], o[order], pos[order]
        first = np.append(True, full[1:] != full[:-1]) if len(full) else np.zeros(0, bool)
        least = ids[o][first][np.cumsum(first) - 1] if len(full) else np.zeros(0, np.int64)
        gone = ids[o] > least
        kind, dest, one, more = [], [], [], []
        send = np.flatnonzero(~gone)
        # the destination comes from another hash than the name sent, so both together tell names apart
        to = (H.mix(H.window_hashes(h, SIZE, 9)[w[order][send]], 3) % H.U(n)).astype(np.int64) if len(send) else np.zeros(0, np.int64)
        for d, i in H.split_by(to, n):
            i = send[i]
            i = i[np.argsort(ids[o[i]], kind="stable")]
            kind.append(0)
            dest.append(d)
            one.append(H.pack(ids[o[i]], tags[o[i]], pos[i], full[i]))
            more.append(b"")
        known = np.flatnonzero(gone)
        for d, i in H.split_by(home(ids[o[known]], tags[o[known]], n), n):
            i = known[i]
            i = i[np.argsort(ids[o[i]], kind="stable")]
            kind.append(1)
            dest.append(d)
            one.append(H.pack(ids[o[i]], tags[o[i]], pos[i]))
            more.append(b"")
        return C.batch(schema, kind=kind, dest=dest, one=one, more=more)

    def run(batches):
        f = H.Flush(flush_words)
        for b in batches:
            for doc, tag, text, blob in zip(b.column("id").to_pylist(), b.column("tag").to_pylist(), C.payloads(b, "text"),
                                            b.column("blob").to_pylist(), strict=True):
                if f.add(doc, tag, text.split(), blob):
                    yield emit(f)
        if f.n:
            yield emit(f)

    return run


def _meet2(n: int):
    """At a destination of window names: the windows that a smaller document has."""
    import pyarrow as pa

    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows or table.column("kind")[0].as_py() == 1:
            return pa.table({"dest": table.column("dest"), "blob": table.column("one")})
        ids, tags, pos, key = H.unpack_all(table.column("one").to_pylist(), "<i8", "<i8", "<u4", "<u8")
        value, back = np.unique(key, return_inverse=True)
        least = np.full(len(value), H.LAST)
        np.minimum.at(least, back, ids)
        gone = ids > least[back]
        return _to_docs(ids[gone], n, tags[gone], pos[gone])

    return run


def _keep(with_text: bool):
    schema = C.arrow(KEPT)

    def run(batches):
        for b in batches:
            rows = {f.name: [] for f in schema}
            for text, blob in zip(C.payloads(b, "text"), b.column("blob").to_pylist(), strict=True):
                words = text.split()
                gone = 0
                n = len(words)
                if blob:
                    edge = np.zeros(n + 1, np.int64)
                    at = np.unique(np.frombuffer(blob, "<u4")).astype(np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + SIZE, -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(keep)]
                    gone = n - len(words)
                left = b" ".join(words)
                rows["n_words"].append(n)
                rows["n_removed"].append(gone)
                rows["kept_text"].append(left if with_text else None)
                rows["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            ids = [None if i == H.LAST else i for i in b.column("id").to_pylist()]
            yield C.batch(schema, **(rows | {"doc_id": ids}))

    return run


def remove_repeats(docs: DataFrame, with_text: bool = True, flush_words: int = 1 << 20, spread: int = 1) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (UTF-8; null unless ``with_text``), kept_sha256 for each row of ``docs``.

    ``spread``: destinations of names per shuffle partition."""
    spark = docs.sparkSession
    C.ship(spark)
    n = max(32, spread * C.partitions(spark))
    src = C.texts(docs).select(F.coalesce("doc_id", F.lit(H.LAST)).alias("id"),
                               F.xxhash64("text").alias("tag"), "text")

    def exchange(rows, meet, value):
        met = rows.groupBy("kind", "dest").applyInArrow(meet, FOUND)
        return met.groupBy("dest").applyInArrow(_of_doc(value), OF_DOC)

    shared = C.saved(exchange(src.mapInArrow(_round1(n, flush_words), ROUTED), _meet1(n), ("u1", 5)), "borders")
    near = src.join(shared, ["id", "tag"])
    gone = exchange(near.mapInArrow(_round2(n, flush_words), ROUTED), _meet2(n), "<u4")
    return src.join(gone, ["id", "tag"], "left").select("id", "text", "blob").mapInArrow(_keep(with_text), KEPT)
