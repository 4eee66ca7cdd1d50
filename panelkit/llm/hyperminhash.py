"""Near-duplicate documents by HyperMinHash.

A document's set holds its distinct shingles (``width`` words; a shorter text is one shingle).
The sketch has 128 buckets.  A shingle's hash picks the bucket; of the least hash in a bucket the
sketch keeps the number of leading zeros (6 bits) and the 10 bits after the leading one, 16
bits in all.  An empty bucket takes the register of the first full bucket in an order of its own
(the same for all documents), so sets of any size fill the sketch.

Bands of 4 registers are the join keys: two sets of Jaccard similarity J meet in one of the 32 bands
with probability 1 - (1 - J^4)^32; at J = 0.8 one pair in 2 * 10^7 is missed.  For pairs that meet, the share of equal registers, less the
expected number of chance collisions, estimates J; pairs whose estimate lies six standard errors below the
threshold are left out, the others are verified on their full sets, word by word.

Groups are never expanded into all pairs.  Texts with one word sequence are one class, represented by the smallest doc_id.
In the *star round* every bucket names a few centres, drawn by hash, and each member is tested against
them; links make components.  What remains - buckets whose members still lie in several components - goes to the *block round*, which
makes no row for a pair that is not a link.  First the sketches alone tell which components hold a likely pair; a block of a bucket
emits only the pairs that join two of its components, and these make wide groups.  Then the shingle hashes of
a wide group's members are compared in blocks of bounded size (members outside the group's largest component against all); a block counts its
intersections and emits again only what joins two components.  No link that the bands reveal is lost, and rows
between tasks grow with the members, not with the pairs.  (A group of n texts that are near, but below the threshold, still costs
n^2 / 2 comparisons of hash sets inside its blocks, and sends each member once for each BLOCK of the others.)

Scale: the sketches are 256 bytes a document; a bucket is never gathered in one task, its centre is an
aggregate and members join back to it (adaptive execution splits a hot bucket).  Texts are shuffled once, for the
members of buckets with two or more; very long ones count by their length when blocks are made.  Nothing is collected but counts.

Defined cases: null or empty text has an empty set and no links; ties and repeated rows: rows of one doc_id are
one node (it has the links of all its texts); a null doc_id gets no component and is kept; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm import common as C
from panelkit.llm import wordhash as H
from panelkit.llm.components import components

BUCKETS, ROWS = 128, 4
BANDS = BUCKETS // ROWS
MANTISSA = 10
BLOCK, BLOCK_WEIGHT = 2048, 1 << 21  # members and shingles of a block
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Order in which each empty bucket looks for a full one.
PROBES = np.stack([np.random.default_rng([20240229, j]).permutation(BUCKETS) for j in range(BUCKETS)])

SKETCH = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
                       T.StructField("content", T.BinaryType()), T.StructField("regs", T.BinaryType())])
PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def shingles(words: list[bytes], width: int) -> set:
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(width)]))


def registers(least: np.ndarray) -> np.ndarray:
    """16-bit registers of least hashes (documents x buckets): leading zeros, then the mantissa."""
    low = least & H.U((1 << 57) - 1)  # the hash without its bucket's 7 bits
    # position of the leading one, found exactly by splitting into two halves that a double holds
    high, rest = (low >> H.U(26)).astype(np.float64), (low & H.U((1 << 26) - 1)).astype(np.float64)
    top = np.where(high > 0, np.frexp(high)[1] + 26, np.frexp(rest)[1])  # bits used
    zeros = np.minimum(57 - top, 63).astype(np.uint64)
    shift = np.maximum(top - 1 - MANTISSA, 0).astype(np.uint64)
    tail = (low >> shift) & H.U((1 << MANTISSA) - 1)
    return ((zeros << H.U(MANTISSA)) | tail).astype("<u2")


def sketches(h: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Registers (n x BUCKETS) from shingle hashes and their documents; every document has a shingle."""
    least = np.full(n * BUCKETS, EMPTY)
    np.minimum.at(least, owner * BUCKETS + (h >> H.U(57)).astype(np.int64), h)
    least = least.reshape(n, BUCKETS)
    full = least != EMPTY
    regs = registers(least)
    row, col = np.nonzero(~full)
    for step in range(BUCKETS):
        if not len(row):
            break
        source = PROBES[col, step]
        hit = full[row, source]
        regs[row[hit], col[hit]] = regs[row[hit], source[hit]]
        row, col = row[~hit], col[~hit]
    return regs


def estimate(equal: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, corrected for chance collisions."""
    chance = BUCKETS * 0.169919 * 2.0 ** -MANTISSA
    return np.maximum((equal - chance) / (BUCKETS - chance), 0)


def likely(equal: np.ndarray, percent: int) -> np.ndarray:
    j = percent / 100
    return estimate(equal) >= j - 6 * np.sqrt(j * (1 - j) / BUCKETS)


def _sketch(width: int, flush_words: int):
    out = C.arrow(SKETCH)

    def emit(f: H.Flush):
        ids, contents = [d for d, _ in f.extra], [c for _, c in f.extra]
        _, _, h, starts = f.arrays()
        f.clear()
        sizes = np.diff(starts)
        n = len(sizes)
        win = np.append(H.window_hashes(h, width), np.zeros(min(width - 1, len(h)), np.uint64))
        owner = np.repeat(np.arange(n), sizes)
        place = np.arange(len(h)) - starts[owner]
        whole = place + width <= sizes[owner]
        short = (sizes > 0) & (sizes < width)
        keys, own = win[whole], owner[whole]
        if short.any():  # the whole sequence as one shingle
            one = np.array([xxhash.xxh3_64_intdigest(contents[i], seed=1) for i in np.flatnonzero(short)], np.uint64)
            keys, own = np.append(keys, one), np.append(own, np.flatnonzero(short))
        order = np.lexsort((keys, own))
        keys, own = keys[order], own[order]
        fresh = np.append(True, (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])) if len(keys) else np.zeros(0, bool)
        count = np.bincount(own[fresh], minlength=n)
        regs = sketches(keys[fresh], own[fresh], n)
        return C.batch(out, doc_id=ids, n_shingles=count, content=contents,
                       regs=[r.tobytes() if c else None for r, c in zip(regs, count, strict=True)])

    def run(batches):
        f = H.Flush(flush_words)
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), C.payloads(b, "text"), strict=True):
                words = text.lower().split()
                if f.add(0, 0, words, (doc, xxhash.xxh3_128_digest(b" ".join(words)))) or len(f.docs) >= 4_096:
                    yield emit(f)
        if f.docs:
            yield emit(f)

    return run


def _bands(reps: DataFrame) -> DataFrame:
    """(band, key, rep): the bands of each class."""
    size = 2 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(
        i.cast("short").alias("band"), F.substring("regs", i * size + 1, F.lit(size)).alias("key")))
    return reps.select("rep", F.explode(keys).alias("x")).select("x.band", F.xxhash64("x.key").alias("key"), "rep")


def _likely_pairs(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches don't rule out the link."""
    regs = reps.select("rep", "regs")
    both = pairs.join(regs.toDF("a", "ra"), "a").join(regs.toDF("b", "rb"), "b").select("a", "b", "ra", "rb")
    out = C.arrow(PAIR)

    def run(batches):
        for b in batches:
            sides = [np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2").reshape(-1, BUCKETS) for c in ("ra", "rb")]
            ok = likely((sides[0] == sides[1]).sum(axis=1), percent)
            yield C.batch(out, a=b.column("a").to_numpy()[ok], b=b.column("b").to_numpy()[ok])

    return both.mapInArrow(run, PAIR).distinct()


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = (pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb"))
    out = C.arrow(PAIR)

    def run(batches):
        import pyarrow as pa

        last, kept = None, set()
        for b in batches:
            rows = ([], [])
            left, right = (b.column(c).cast(pa.large_binary()) for c in ("ta", "tb"))
            for i, (x, y) in enumerate(zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True)):
                s, t = left[i].as_py() or b"", right[i].as_py() or b""  # two texts at a time: a batch may hold many long ones
                if t != last:
                    last, kept = t, shingles(t.lower().split(), width)
                other = shingles(s.lower().split(), width)
                common = len(kept & other)
                if 100 * common >= percent * (len(kept) + len(other) - common):
                    rows[0].append(x)
                    rows[1].append(y)
            yield C.batch(out, a=rows[0], b=rows[1])

    return both.mapInArrow(run, PAIR)


def _rooted(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return rows.withColumn("root", F.col("rep"))
    return rows.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))


def _star_pairs(members: DataFrame, centres: int) -> DataFrame:
    """Members of buckets, each with its bucket's centres."""
    names = [f"c{i}" for i in range(centres)]
    centre = members.groupBy("band", "key").agg(*[
        F.min(F.struct(F.xxhash64("rep", F.lit(i)).alias("h"), "rep")).alias(c) for i, c in enumerate(names)])
    centre = centre.select("band", "key", F.explode(F.array_distinct(F.array(*[F.col(f"{c}.rep") for c in names]))).alias("b"))
    pairs = members.join(centre, ["band", "key"]).where("rep <> b")
    return pairs.select(F.greatest("rep", "b").alias("a"), F.least("rep", "b").alias("b")).distinct()


def _joined(labels: np.ndarray, mine: np.ndarray, hits: np.ndarray, own: int, found: list) -> None:
    """Union of the label of entry ``own`` with those of the entries ``hits``; adds (own, entry) to ``found`` where two labels meet.
    ``mine`` maps entries to label slots."""
    others, first = np.unique(labels[mine[hits]], return_index=True)
    here = labels[mine[own]]
    for label, at in zip(others, first, strict=True):
        if label != here:
            found.append((own, int(hits[at])))
            labels[labels == label] = here


def _cells(rows: DataFrame, group: list[str], weight: str) -> DataFrame:
    """Rows of each group dealt into pairs of blocks (x, o): rows outside the group's largest root (``outer``) against all.
    A block has about BLOCK rows and BLOCK_WEIGHT of ``weight``.  Groups of one root are left out."""
    sizes = rows.groupBy(*group, "root").agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w"))
    top = sizes.groupBy(*group).agg(F.max(F.struct("n", "root", "w")).alias("top"), F.sum("n").alias("n"), F.sum("w").alias("w"),
                                    F.count(F.lit(1)).alias("roots")).where("roots > 1")

    def blocks(n, w):
        return F.greatest(F.ceil(n / BLOCK), F.ceil(w / BLOCK_WEIGHT)).cast("int")

    top = top.select(*group, F.col("top.root").alias("main"), blocks(F.col("n"), F.col("w")).alias("xs"),
                     blocks(F.col("n") - F.col("top.n"), F.col("w") - F.col("top.w")).alias("os"))
    rows = rows.join(top, group)
    cell = F.pmod(F.xxhash64("rep"), F.lit(1 << 30))
    as_x = rows.withColumns({"x": F.pmod(cell, F.col("xs")).cast("int"), "o": F.explode(F.sequence(F.lit(0), F.col("os") - 1)), "outer": F.lit(False)})
    as_o = rows.where("root <> main").withColumns({"o": F.pmod(cell, F.col("os")).cast("int"), "x": F.explode(F.sequence(F.lit(0), F.col("xs") - 1)),
                                                   "outer": F.lit(True)})
    return as_x.drop("main", "xs", "os").unionByName(as_o.drop("main", "xs", "os"))


def _likely_roots(members: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Links between components, enough to join all that hold a pair of one bucket whose sketches don't rule out a link: at most as
    many as a block has components."""
    rows = members.join(reps.select("rep", "regs"), "rep").withColumn("w", F.lit(1))
    out = C.arrow(PAIR)

    def run(table):
        import pyarrow as pa

        outer = np.array(table.column("outer").to_pylist(), bool)
        root = table.column("root").to_numpy()
        regs = np.frombuffer(b"".join(table.column("regs").to_pylist()), "<u2").reshape(-1, BUCKETS)
        names, mine = np.unique(root, return_inverse=True)
        labels, found = np.arange(len(names)), []
        inner = np.flatnonzero(~outer)
        for i in np.flatnonzero(outer):
            rest = inner[labels[mine[inner]] != labels[mine[i]]]  # the others are joined already
            hits = rest[likely((regs[rest] == regs[i]).sum(axis=1), percent)]
            if len(hits):
                _joined(labels, mine, hits, int(i), found)
        pairs = np.array([(max(root[i], root[j]), min(root[i], root[j])) for i, j in found], np.int64).reshape(-1, 2)
        return pa.Table.from_batches([C.batch(out, a=pairs[:, 0], b=pairs[:, 1])])

    cells = _cells(rows, ["band", "key"], "w").select("band", "key", "x", "o", "outer", "root", "regs")
    return cells.groupBy("band", "key", "x", "o").applyInArrow(run, PAIR).distinct()


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    if 0 < len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    return np.unique(H.window_hashes(H.word_hashes(words), width))


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(rep, w, hashes): the shingle hashes of each text and their number."""
    schema = "rep long, w long, hashes binary"
    out = pa_schema(schema)

    def run(batches):
        for b in batches:
            sets = [shingle_hashes(t.lower().split(), width) for t in C.payloads(b, "text")]
            yield C.batch(out, rep=b.column("rep").to_pylist(), w=[len(s) for s in sets], hashes=[s.tobytes() for s in sets])

    return texts.select("rep", "text").mapInArrow(run, schema)


def pa_schema(ddl: str):
    return C.arrow(T.StructType.fromDDL(ddl))


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left sets with all right sets.  Shingles that many sets share are counted by one matrix
    product, the others by listing the pairs of sets that hold them."""
    n, m = len(left), len(right)
    total = np.zeros(n * m, np.float32)
    flat = np.concatenate([*left, *right]) if n + m else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n + m), [len(s) for s in [*left, *right]])
    _, ids = np.unique(flat, return_inverse=True)
    is_left = owner < n
    size = ids.max(initial=-1) + 1
    in_left, in_right = np.bincount(ids[is_left], minlength=size), np.bincount(ids[~is_left], minlength=size)
    pairs = in_left * in_right
    dense = pairs * 128 > n * m
    order = np.argsort(ids, kind="stable")
    ids, owner, is_left = ids[order], owner[order], is_left[order]

    columns = np.flatnonzero(dense)
    for i in range(0, len(columns), 1024):
        part = columns[i:i + 1024]
        place = np.full(size, -1)
        place[part] = np.arange(len(part))
        a, b = np.zeros((n, len(part)), np.float32), np.zeros((m, len(part)), np.float32)
        at = place[ids]
        use = at >= 0
        a[owner[use & is_left], at[use & is_left]] = 1
        b[owner[use & ~is_left] - n, at[use & ~is_left]] = 1
        total += (a @ b.T).ravel()

    sparse = np.flatnonzero(~dense & (pairs > 0))
    lo, ro = owner[is_left], owner[~is_left] - n  # owners by shingle
    l_at, r_at = np.cumsum(in_left) - in_left, np.cumsum(in_right) - in_right
    done = 0
    while done < len(sparse):
        upto = done + max(1, int(np.searchsorted(np.cumsum(pairs[sparse[done:done + 65536]]), 1 << 21)))
        part = sparse[done:upto]
        done = upto
        k = pairs[part]
        col = np.repeat(part, k)
        step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        i, j = lo[l_at[col] + step // in_right[col]], ro[r_at[col] + step % in_right[col]]
        total += np.bincount(i * m + j, minlength=n * m)
    return total.reshape(n, m).astype(np.int64)


def _linked(grouped: DataFrame, percent: int) -> DataFrame:
    """Links found on full sets, (rep, rep): at most as many per block as it has components, and enough to join what is linked."""
    out = C.arrow(PAIR)

    def run(table):
        import pyarrow as pa

        outer = np.array(table.column("outer").to_pylist(), bool)
        rep, root = table.column("rep").to_numpy(), table.column("root").to_numpy()
        sets = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
        size = np.array([len(s) for s in sets])
        inner, outside = np.flatnonzero(~outer), np.flatnonzero(outer)
        names, mine = np.unique(root, return_inverse=True)
        labels, found = np.arange(len(names)), []
        both = common_counts([sets[i] for i in outside], [sets[j] for j in inner])
        for r, i in enumerate(outside):
            hits = inner[100 * both[r] >= percent * (size[i] + size[inner] - both[r])]
            hits = hits[labels[mine[hits]] != labels[mine[i]]]
            if len(hits):
                _joined(labels, mine, hits, int(i), found)
        pairs = np.array([(max(rep[i], rep[j]), min(rep[i], rep[j])) for i, j in found], np.int64).reshape(-1, 2)
        return pa.Table.from_batches([C.batch(out, a=pairs[:, 0], b=pairs[:, 1])])

    cells = _cells(grouped, ["wide"], "w").select("wide", "x", "o", "outer", "rep", "root", "hashes")
    return cells.groupBy("wide", "x", "o").applyInArrow(run, PAIR).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, centres: int = 2, flush_words: int = 1 << 18) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.  Documents are linked where
    100 * |intersection| >= percent * |union|; ``centres`` (of each bucket in the star round) trades work between the rounds and doesn't change the result."""
    C.ship(docs.sparkSession)
    sketch = C.saved(C.texts(docs).mapInArrow(_sketch(width, flush_words), SKETCH), "sketches")
    linked = sketch.where("n_shingles > 0 and doc_id is not null")
    # the sketch depends on the words alone: any row of a class has the class's registers
    reps = C.saved(linked.groupBy("content").agg(F.min("doc_id").alias("rep"), F.min("regs").alias("regs")), "classes")
    of_doc = linked.select("doc_id", "content").join(reps.select("content", "rep"), "content").select("doc_id", "rep")
    # a doc_id with several texts ties their classes together
    ties = of_doc.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).where("a <> b")
    ties = of_doc.join(ties, "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b")

    bands = _bands(reps)
    crowded = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = C.saved(bands.join(crowded, ["band", "key"]), "bands")
    met = members.select("rep").distinct()
    texts = C.texts(docs).join(met, F.col("doc_id") == F.col("rep")).select("rep", "text").distinct()
    texts = C.saved(texts, "texts")

    def confirmed(pairs):
        return C.saved(_verified(_likely_pairs(pairs, reps, percent), texts, width, percent), "links")

    links, roots = C.saved(ties, "links"), None
    if centres:
        links = C.saved(links.union(confirmed(_star_pairs(members, centres))), "links")
    if links.head(1):
        roots = C.saved(components(links), "roots")
    rooted = _rooted(members, roots)
    maybe = C.saved(_likely_roots(rooted, reps, percent), "maybe")
    if maybe.head(1):
        wide = components(maybe).select(F.col("node").alias("root"), F.col("root").alias("wide"))
        near = _rooted(met, roots).select("rep", "root").join(wide, "root").join(_sets(texts, width), "rep")
        near = C.saved(near, "sets")
        rest = C.saved(_verified(_linked(near, percent), texts, width, percent), "links")
        if rest.head(1):
            roots = C.saved(components(links.union(rest)), "roots")
        C.drop(near, rest)
    C.drop(members, texts, links, maybe)
    rooted = _rooted(of_doc, roots).groupBy("doc_id").agg(F.min("root").alias("component_id"))
    out = sketch.select("doc_id", "n_shingles").join(rooted, "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, all columns, whose document is the smallest of its component."""
    kept = C.unused(docs, "kept_id")
    stay = near_duplicates(docs, **how).where("kept").select(F.col("doc_id").alias(kept)).distinct()
    return docs.join(stay, docs["doc_id"].cast("long").eqNullSafe(stay[kept]), "left_semi")
