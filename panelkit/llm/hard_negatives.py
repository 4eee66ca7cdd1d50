"""Hard negatives of anchors, scored by Kronecker-packed products.

Components become the integers floor(256 * c).  A block of candidates is biased to be non-negative, and the same component of several
candidates is laid into separated fields of one wide integer.  Multiplying that integer by an anchor's (biased) component multiplies
all fields at once; after the sum over the components each field holds one candidate's product, because a field is as wide as
the largest possible sum.  Taking the biases out again gives the exact scores.

Two carriers hold the wide integers: where two or more fields fit 53 bits, doubles (whole numbers below 2^53 are exact in them, so the
sums run as one matrix product); else Python integers of any width, with thousands of fields each.

A row's positives are its first rows of the same label by falling score; a positive's negatives the first rows of
other labels with low * positive <= 100 * score <= 100 * positive.  Ties go to the smaller id.

Scale: the anchors are a stated set of queries against all rows, in blocks.  Rows are dealt evenly over blocks by a row number,
whatever their label or vector, and each pair of blocks is one small task: no row of a hot label meets another one in a
group of its own.  A task keeps the first few of each anchor (and positive); the same limit is
applied again before and after the shuffle by anchor.  Nothing is collected but two counts.

Defined cases: rows with a null label, or without a usable vector (see ``vectors``), take no part; rows with a null id
are never anchors and come last among ties; repeated rows are rows of their own, each an anchor, positive or negative (an
anchor's own row alone is left out); an anchor without positives, or a positive without negatives, gives no row; an empty
table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm import common as C
from panelkit.llm import vectors as V

ANCHORS, CANDIDATES, CHUNK = 2048, 16384, 256
POSITIVES = "anchor long, a_id long, other long, o_id long, unknown boolean, score long"
NEGATIVES = ("anchor long, a_id long, other long, o_id long, unknown boolean, p_score long, "
             "neg long, n_id long, n_unknown boolean, score long")


# ------------------------------------------------------------------ packed products
class Packed:
    """Integer vectors (rows x dim) as wide integers, ready to be multiplied by other vectors whose entries lie in
    [-reach, reach]."""

    def __init__(self, x: np.ndarray, reach: int):
        self.n, self.dim = x.shape
        self.low = int(x.min(initial=0))
        self.reach = int(reach)
        span = int(x.max(initial=0)) - self.low
        self.bits = max(1, (self.dim * span * 2 * self.reach).bit_length())  # a field holds the largest sum
        self.sums = x.sum(axis=1) if self._small(x) else np.array([sum(map(int, r)) for r in x], object)
        self.fields = 53 // self.bits
        if self.fields >= 2:
            per = -(-self.n // self.fields)
            word = np.zeros((per, self.dim))
            for f in range(self.fields):
                part = (x[f * per:(f + 1) * per] - self.low).astype(np.float64)
                word[:len(part)] += np.ldexp(part, f * self.bits)
            self.words = np.ascontiguousarray(word.T)
        else:
            self.width = -(-self.bits // 8)  # whole bytes
            self.words = [self._wide([int(a) - self.low for a in col]) for col in x.T]

    @staticmethod
    def _small(x: np.ndarray) -> bool:
        return float(np.abs(x.astype(np.float64)).max(initial=0)) * x.shape[1] < 2.0 ** 62

    def _wide(self, column: list[int]) -> int:
        return int.from_bytes(b"".join(a.to_bytes(self.width, "little") for a in column), "little")

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products (anchors x rows): int64, or Python integers where those may not fit."""
        out = self._narrow(anchors) if self.fields >= 2 else self._broad(anchors)
        return out

    def _narrow(self, anchors: np.ndarray) -> np.ndarray:
        total = ((anchors + self.reach).astype(np.float64) @ self.words).astype(np.int64)  # one product for all fields
        mask = (1 << self.bits) - 1
        parts = [(total >> (f * self.bits)) & mask for f in range(self.fields)]
        raw = np.concatenate(parts, axis=1)[:, :self.n]
        # (a + R)(x - L) = a x - a L + R x - R L
        return raw + self.low * anchors.sum(axis=1)[:, None] - self.reach * self.sums[None, :] + self.dim * self.reach * self.low

    def _broad(self, anchors: np.ndarray) -> np.ndarray:
        rows = []
        for a in anchors:
            total = sum((int(c) + self.reach) * w for c, w in zip(a, self.words, strict=True))
            raw = total.to_bytes(self.width * self.n, "little")
            own = self.low * sum(map(int, a)) + self.dim * self.reach * self.low
            rows.append([int.from_bytes(raw[i * self.width:(i + 1) * self.width], "little") + own - self.reach * int(s)
                         for i, s in enumerate(self.sums)])
        out = np.array(rows, object).reshape(len(anchors), self.n)
        fits = not out.size or max(abs(int(out.max())), abs(int(out.min()))) < 1 << 62
        return out.astype(np.int64) if fits else out


def first_k(scores: np.ndarray, ok: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row the indices of its first k entries that are ``ok``, by falling score, then rising index."""
    m, n = scores.shape
    if not n:
        return [np.zeros(0, np.int64)] * m
    place = np.arange(n - 1, -1, -1)
    if scores.dtype == object or float(np.abs(scores).max(initial=0)) * n >= 2.0 ** 62:
        return [np.array([j for _, j in sorted((-int(s[j]), j) for j in np.flatnonzero(o))[:k]], np.int64) for s, o in zip(scores, ok, strict=True)]
    lowest = np.iinfo(np.int64).min
    key = np.where(ok, scores * n + place, lowest)
    top = np.argpartition(key, n - k, axis=1)[:, n - k:] if n > k else np.tile(np.arange(n), (m, 1))
    values = np.take_along_axis(key, top, axis=1)
    order = np.argsort(-values, axis=1, kind="stable")  # keys of one row differ, but for those not ok
    top, values = np.take_along_axis(top, order, axis=1), np.take_along_axis(values, order, axis=1)
    return [t[v > lowest] for t, v in zip(top, values, strict=True)]


class _Block:
    """Rows of one side of a task, by (id, null ids last, row number)."""

    def __init__(self, t: pa.Table, dim: int):
        ids = t.column("vec_id").combine_chunks()
        self.unknown = np.array(ids.is_null())
        self.id, self.rid = ids.fill_null(0).to_numpy(), t.column("rid").to_numpy()
        order = np.lexsort((self.rid, self.id, self.unknown))
        self.unknown, self.id, self.rid = self.unknown[order], self.id[order], self.rid[order]
        self.label = t.column("label").to_numpy()[order]
        self.x = V.matrix(t.column("x"), dim)[order]
        self.table, self.order = t, order


def _reach(x: np.ndarray) -> int:
    return max(1, abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))


def _positives(k: int, dim: int):
    out = C.arrow(V.struct_of(POSITIVES))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        a, c = _Block(left, dim), _Block(right, dim)
        packed, found = Packed(c.x, _reach(a.x)), []
        for i in range(0, len(a.x), CHUNK):
            s = packed.scores(a.x[i:i + CHUNK])
            ok = (a.label[i:i + CHUNK, None] == c.label) & (a.rid[i:i + CHUNK, None] != c.rid)
            for r, picks in enumerate(first_k(s, ok, k)):
                found += [(a.rid[i + r], a.id[i + r], c.rid[j], None if c.unknown[j] else c.id[j], bool(c.unknown[j]), int(s[r, j])) for j in picks]
        return _rows(found, out)

    return run


def _negatives(k: int, low: int, dim: int):
    out = C.arrow(V.struct_of(NEGATIVES))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        a, c = _Block(left, dim), _Block(right, dim)
        pos = [left.column("positives")[int(i)].as_py() for i in a.order]
        packed, found = Packed(c.x, _reach(a.x)), []
        for i in range(0, len(a.x), CHUNK):
            s = packed.scores(a.x[i:i + CHUNK])
            other = a.label[i:i + CHUNK, None] != c.label
            for r in range(len(s)):
                for p in pos[i + r]:
                    ok = other[r] & (100 * s[r] <= 100 * p["score"]) & (100 * s[r] >= low * p["score"])
                    for j in first_k(s[r:r + 1], ok[None, :], k)[0]:
                        found.append((a.rid[i + r], a.id[i + r], p["other"], p["o_id"], p["unknown"], p["score"],
                                      c.rid[j], None if c.unknown[j] else c.id[j], bool(c.unknown[j]), int(s[r, j])))
        return _rows(found, out)

    return run


def _rows(found: list[tuple], schema: pa.Schema) -> pa.Table:
    if not found:
        return schema.empty_table()
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)


def mine(rows: DataFrame, anchors, id_col: str = "vec_id", vec_col: str = "embedding", label=None, positives: int = 5,
         negatives: int = 5, low: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.  ``anchors``: condition on the id column
    that an anchor meets; ``label``: label column or expression."""
    spark = rows.sparkSession
    C.ship(spark)
    label = F.col("label") if label is None else label
    src, dim = V.usable(rows, vec_col, F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                        F.coalesce(anchors, F.lit(False)).alias("anchor"))
    src = src.where("label is not null").select("vec_id", "label", "anchor", V.scaled().alias("x"))
    src = C.saved(src.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    n, n_anchors = src.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    wide = C.partitions(spark)
    n_right = V.blocks_for(n, CANDIDATES, 1024, wide)
    n_left = V.blocks_for(n_anchors, ANCHORS, ANCHORS, 1)
    left = src.where("anchor").select("rid", "vec_id", "label", "x")
    right = src.select("rid", "vec_id", "label", "x")

    pos = V.grid(left, right, n_left, n_right, _positives(positives, dim), POSITIVES)
    pos = V.best(pos, ["anchor"], [F.desc("score"), "unknown", "o_id", "other"], positives, "p")
    pos = pos.groupBy("anchor").agg(F.collect_list(F.struct("other", "o_id", "unknown", "score")).alias("positives"))  # at most ``positives``
    pos = C.saved(pos, "positives")
    known = C.saved(left.join(pos.withColumnRenamed("anchor", "rid"), "rid"), "anchors")
    C.drop(pos)

    neg = V.grid(known, right, n_left, n_right, _negatives(negatives, low, dim), NEGATIVES)
    neg = V.best(neg, ["anchor", "other"], [F.desc("score"), "n_unknown", "n_id", "neg"], negatives)
    return neg.select(F.col("a_id").alias("anchor_id"), F.col("o_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                      F.col("n_id").alias("negative_id"), F.col("p_score").alias("positive_score"), F.col("score").alias("negative_score"))
