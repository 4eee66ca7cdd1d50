"""The operators on embeddings against plain numpy and Python, on odd rows and on an empty table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import ann_graph, hard_negatives, whitening
from panelkit.llm import common as C

COLUMNS = "vec_id long, embedding array<float>, label int, rid int, n int, v double, x string, node int, slot int, score double"
SF = "/root/testdata/sf0.001"


def odd_rows():
    """vec_id, vector, label: nulls, empty, non-finite, zero and short vectors, ties, repeated rows, one hot vector, null ids."""
    r = np.random.default_rng(3)
    rows = [(i, r.normal(0, 0.2, 6).astype(np.float32).tolist(), int(r.integers(0, 3))) for i in range(330)]
    rows += [(400 + i, [0.25, -0.125, 0.5, 0.0, 0.125, 0.0], i % 3) for i in range(150)]
    rows += [(700 + i, [0.25, -0.125, 0.5, 0.0, 0.125, 0.0], 1) for i in (0, 0, 0, 1)]
    rows += [(800, None, 1), (801, [], 1), (802, [None] * 6, 1), (803, [0.1, None, 0.1, 0.1, 0.1, 0.1], 1), (804, [float("nan")] * 6, 1),
             (805, [float("inf")] + [0.0] * 5, 1), (806, [0.0] * 6, 1), (807, [0.1, 0.2], 1), (808, [0.1] * 6, None), (900, [0.3] * 6, 2),
             (900, [0.3] * 6, 2), (None, [0.2] * 6, 1), (None, [0.2] * 6, 2), (1000, [-0.3] * 6, 0)]
    return rows


def fine(v):
    return v is not None and len(v) == 6 and all(c is not None and np.isfinite(c) for c in v)


@pytest.fixture(scope="module")
def rows():
    return odd_rows()


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3.0, "x", 4, 5, 6.0) for r in rows], COLUMNS).repartition(4).cache()


# 11 --------------------------------------------------------------------------------------------
@pytest.mark.parametrize("dim,kind", [(1, "wide"), (7, "wide"), (24, "wide"), (24, "flat"), (24, "equal")])
def test_spectrum_of_rank_one_updates(dim, kind):
    r = np.random.default_rng(dim)
    x = r.integers(-80, 80, (300, dim)).astype(float)
    if kind == "flat":
        x[:, dim // 2:] = x[:, :1]
    if kind == "equal":
        x = np.repeat(np.eye(dim) * 40, 5, axis=0)
    parts = []
    for chunk in np.array_split(x, 4):
        s = whitening.Spectrum.empty(dim)
        for row in chunk:  # every row by itself
            s.add_rows(row[None, :])
        parts.append(s)
    whole = parts[0]
    for s in parts[1:]:
        whole.add(s)
    c = x - x.mean(axis=0)
    size = max(np.linalg.norm(c.T @ c), 1)
    assert whole.n == 300 or kind == "equal"
    assert np.abs(whole.mean - x.mean(axis=0)).max() < 1e-9
    assert np.abs(whole.lam - np.linalg.eigvalsh(c.T @ c)).max() < 1e-11 * size
    assert np.abs(whole.q * whole.lam @ whole.q.T - c.T @ c).max() < 1e-11 * size
    assert np.abs(whole.q.T @ whole.q - np.eye(dim)).max() < 1e-10


def brute_whitening(rows, k=4):
    keep = [(d, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for d, v, _ in rows if fine(v)]
    u = np.unique(np.stack([x for _, x in keep]), axis=0)
    n, s = len(u), u.sum(axis=0)
    e, q = np.linalg.eigh(np.cov(u.T, bias=True))
    e, q = e[::-1], q[:, ::-1]
    return n, [(d, int(((n * x - s) ** 2).sum()), ((x - s / n) @ q[:, :k]) / np.sqrt(e[:k])) for d, x in keep], e[:k] / e.sum()


@pytest.mark.parametrize("block", [1, 64])
def test_whitening(table, rows, block):
    n, exp, share = brute_whitening(rows)
    got = whitening.whiten(table, block=block).collect()
    assert len(got) == 4 * len(exp) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    for k in range(4):
        mine = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, abs(r.whitened)) for r in got if r.component == k + 1)
        want = sorted((d is None, d or 0, v, abs(float(w[k]))) for d, v, w in exp)
        assert [m[:3] for m in mine] == [w[:3] for w in want]
        assert np.allclose([m[3] for m in mine], [w[3] for w in want], atol=1e-9)
        signs = {np.sign(r.whitened * w[k]) for r in got if r.component == k + 1 for d, _, w in exp if d == r.vec_id and abs(w[k]) > 1e-6}
        assert len(signs) == 1  # one sign for all rows
        assert np.isclose(next(r.explained for r in got if r.component == k + 1), share[k], rtol=1e-9)


def test_whitening_without_variance(spark):
    flat = spark.createDataFrame([(i, [0.5, 0.25 * (i % 2), -0.5]) for i in range(6)], "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.component): r for r in whitening.whiten(flat).collect()}
    assert len(got) == 18 and got[0, 1].n == 2 and abs(abs(got[0, 1].whitened) - 1) < 1e-12 and got[0, 1].explained == 1.0
    assert got[0, 2].whitened is None and got[0, 1].identity_error < 1e-9
    one = whitening.whiten(flat.where("vec_id = 1")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, 0.0)] * 3


def test_whitening_wide_numbers():
    big = np.array([[1 << 40, -(1 << 41)], [3, 5]])
    assert whitening.exact_sums(np.repeat(big, 3, axis=0)) == [3 * ((1 << 40) + 3), 3 * (5 - (1 << 41))]
    sums = whitening.exact_sums(big)
    assert whitening.deviations(big, 2, sums) == [None, None]
    assert whitening.deviations(np.array([[7, -7]]), 10**6, [10**6, 10**6]) == [36 * 10**12 + 64 * 10**12]


# 12 --------------------------------------------------------------------------------------------
@pytest.mark.parametrize("low,high,dim", [(-60, 60, 64), (0, 1, 3), (-2**20, 2**20, 8), (-2**40, 2**40, 3), (-5, -4, 2)])
def test_packed_products_are_exact(low, high, dim):
    r = np.random.default_rng(dim)
    x, a = r.integers(low, high, (37, dim)), r.integers(low, high, (5, dim))
    got = hard_negatives.Packed(x, hard_negatives._reach(a)).scores(a)
    assert [[int(s) for s in row] for row in got] == [[sum(int(p) * int(q) for p, q in zip(u, w, strict=True)) for w in x] for u in a]


def brute_negatives(rows, step):
    keep = [(d, [int(c) for c in np.floor(256 * np.array(v, np.float32).astype(float))], y) for d, v, y in rows if fine(v) and y is not None]
    first = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for i, (d, x, y) in enumerate(keep):
        if d is None or d % step:
            continue
        scores = [(sum(a * b for a, b in zip(x, w, strict=True)), e, z) for j, (e, w, z) in enumerate(keep) if j != i]
        for p, e, _ in sorted((s for s in scores if s[2] == y), key=first)[:5]:
            negatives = sorted((s for s in scores if s[2] != y and 80 * p <= 100 * s[0] <= 100 * p), key=first)[:5]
            out += [(d, e, r + 1, f, p, s) for r, (s, f, _) in enumerate(negatives)]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_hard_negatives(table, rows, monkeypatch):
    exp = sorted(brute_negatives(rows, 10), key=key)
    assert len(exp) > 100
    for size in (1 << 14, 40):
        monkeypatch.setattr(hard_negatives, "CANDIDATES", size)
        monkeypatch.setattr(hard_negatives, "ANCHORS", 7 if size == 40 else 2048)
        got = hard_negatives.mine(table, F.col("vec_id") % 10 == 0).collect()
        assert sorted(map(tuple, got), key=key) == exp


def test_first_k_of_wide_scores():
    s = np.array([[5, 1 << 70, 5, -(1 << 70), 7]], object)
    ok = np.array([[True, True, True, True, False]])
    assert hard_negatives.first_k(s, ok, 3)[0].tolist() == [1, 0, 2]
    assert hard_negatives.first_k(np.array([[3, 9, 9, 1]]), np.array([[True, True, True, False]]), 5)[0].tolist() == [1, 2, 0]


# 13 --------------------------------------------------------------------------------------------
def brute_nearest(rows, step, k=20):
    keep = [(d, np.array(v, np.float32).astype(float)) for d, v, _ in rows if fine(v) and any(v)]
    x = np.stack([v for _, v in keep])
    out = []
    for i, (d, v) in enumerate(keep):
        if d is not None and d % step == 0:
            s = (x * v).sum(axis=1)
            best = sorted((-float(s[j]), keep[j][0] is None, keep[j][0] or 0) for j in range(len(keep)) if j != i)[:k]
            out += [(d, r + 1, None if u else e, -t) for r, (t, u, e) in enumerate(best)]
    return out


@pytest.mark.parametrize("shard", [8192, 60])
def test_graph_search(table, rows, shard):
    exp = brute_nearest(rows, 20)
    index = ann_graph.build_index(table, shard=shard)
    assert index.table.agg(F.sum("n_rows")).first()[0] == sum(fine(v) and any(v) for _, v, _ in rows)  # every row is indexed
    got = [tuple(r) for r in ann_graph.search(index, table.where("vec_id % 20 = 0"), block=9).collect()]
    assert len(got) == len(exp) and len(index.table.select("shard").distinct().collect()) == index.shards
    assert len(set(got) & set(exp)) >= 0.99 * len(set(exp))  # scores and ties included
    hot = [r for r in got if r[0] == 700]
    assert all(r[2] >= 400 for r in hot[:20])
    with pytest.raises(ValueError):
        ann_graph.search(index, table, k=21)


def test_graph_reaches_every_node():
    r = np.random.default_rng(2)
    for x in (r.normal(size=(700, 8)), np.concatenate([r.normal(10, 0.01, (200, 3)), r.normal(-10, 0.01, (200, 3))]), r.normal(size=(1, 4))):
        edges, starts = ann_graph.build_graph(x, degree=6, width=12)
        assert ann_graph.reachable(edges, starts).all() and edges.shape == (len(x), 6)
        assert all(i not in e and len(set(e[e >= 0])) == (e >= 0).sum() for i, e in enumerate(edges))


def test_graph_recall(spark):
    e = C.table(spark, "/root/testdata/sf0.1", "embeddings")
    got = ann_graph.search(ann_graph.build_index(e, shard=700), e.where("vec_id % 20 = 0")).collect()
    data = e.collect()
    x, ids = np.array([r.embedding for r in data], np.float64), np.array([r.vec_id for r in data])
    right = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        right += len(set(ids[np.lexsort((ids, -s))[:20]]) & {r.vec_id for r in got if r.query_id == ids[i]})
    assert right >= 0.98 * 20 * (ids % 20 == 0).sum()


# all -------------------------------------------------------------------------------------------
def test_empty_tables(spark, table):
    for t in (table.where("false"), table.where("vec_id in (800, 801)")):
        assert whitening.whiten(t).collect() == []
        assert hard_negatives.mine(t, F.col("vec_id") % 10 == 0).collect() == []
        assert ann_graph.search(ann_graph.build_index(t), t).collect() == []
    index = ann_graph.build_index(table)
    assert ann_graph.search(index, table.where("false")).collect() == []
    assert hard_negatives.mine(table, F.col("vec_id") < 0).collect() == []
    lonely = table.where("vec_id = 1")
    assert ann_graph.search(ann_graph.build_index(lonely), lonely).collect() == []
