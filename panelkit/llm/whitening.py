"""Whitening of embeddings by incremental eigendecomposition.

Vectors are scaled to integers, x = floor(256 * c); the *fit list* holds each distinct x once.

1. Each partition of the fit list keeps the spectrum of what it has seen: count, mean, eigenvalues and
   eigenvectors of the scatter about the mean.  A block of rows is centred, turned by an orthogonal
   triangularisation into at most ``dim`` rows of the same scatter, and each of these is a rank-one update: the
   eigenvalues of D + z z' are the roots of a secular equation, one between each two poles; small entries of z and equal poles
   are deflated first; eigenvectors come from the z that fits the roots found, so they stay orthogonal.  A shift of the mean is
   one more rank-one update.  (``block=1`` applies every row by itself.)
2. Spectra are combined level by level on the executors: the eigenpairs of one are successive rank-one updates of the other.
3. Rayleigh-Ritz refinement: all rows of the fit list, centred with the exact mean, are projected on the
   basis; the small matrix of their products is solved and turns the basis.  This repeats until the projected matrix is diagonal to
   double precision (``passes`` at most).
4. One more pass measures the covariance of the whitened fit list.

Scale: the fit list is one shuffle with map-side removal of copies, so a vector that a third of all rows share arrives once per
partition.  States have dim * dim doubles; groups of 32 of them meet in a task, and only the last one (its size depends on the
dimension alone) reaches the driver.  All passes are over a written table, so a lost executor costs its tasks only.

Defined cases: rows without a usable vector (see ``vectors``) give no rows; a null id is kept; repeated rows count once in the
fit list and are each returned; with fewer dimensions than components there are fewer components; a component
without variance (e <= 1e-12 of the trace) has a null whitened value and no part in identity_error; a deviation that does not
fit a long is null; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm import common as C
from panelkit.llm import vectors as V

EPS = np.finfo(np.float64).eps
HALVINGS = 64
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ------------------------------------------------------------------ rank-one updates
def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum_j z_j^2 / (d_j - t) for strictly ascending d and nonzero z.  Returns them and the matrix of
    d_j - t_i, exact to the last bits because each root is kept as an offset from its nearer pole."""
    k, w = len(d), z * z
    gap = np.append(d[1:] - d[:-1], w.sum())
    mid = 1 + (w / (d[None, :] - (d + gap / 2)[:, None])).sum(axis=1)
    right = mid < 0  # f rises from pole to pole: the root lies right of the middle
    right[-1] = False  # the last interval has no pole at its right end
    origin = np.where(right, np.append(d[1:], d[-1]), d)
    far = d[None, :] - origin[:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.append(gap[:-1] / 2, gap[-1]))
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(HALVINGS):
            at = (low + high) / 2
            rising = 1 + (w / (far - at[:, None])).sum(axis=1) >= 0
            high = np.where(rising, at, high)
            low = np.where(rising, low, at)
    at = np.where(right, low, high)  # never the pole itself
    return origin + at, far - at[:, None]


def rank_one(lam: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of q diag(lam) q' + v v'."""
    z = q.T @ v
    size = float(z @ z)
    if size == 0.0:
        return lam, q
    lam, q = lam.copy(), q.copy()
    tol = 8 * EPS * max(float(np.abs(lam).max()), size)
    alive, last = [], -1
    for j in range(len(lam)):
        if abs(z[j]) * np.sqrt(size) <= tol:  # deflation: this pair does not change
            continue
        if last >= 0:
            r = np.hypot(z[last], z[j])
            c, s = z[j] / r, z[last] / r
            if abs((lam[j] - lam[last]) * c * s) <= tol:  # equal poles: turn one entry of z into zero
                a, b = q[:, last].copy(), q[:, j].copy()
                q[:, last], q[:, j] = c * a - s * b, s * a + c * b
                lam[last], lam[j] = lam[last] * c * c + lam[j] * s * s, lam[last] * s * s + lam[j] * c * c
                z[last], z[j] = 0.0, r
                alive.pop()
        alive.append(j)
        last = j
    if alive:
        act = np.array(alive)
        d, w = lam[act], z[act]
        up = np.argsort(d, kind="stable")
        act, d, w = act[up], d[up], w[up]
        roots, diff = secular_roots(d, w)
        # the z for which these roots are exact; its eigenvectors are orthogonal
        poles = d[:, None] - d[None, :]
        np.fill_diagonal(poles, 1.0)
        fit = np.exp((np.log(np.abs(diff)).sum(axis=0) - np.log(np.abs(poles)).sum(axis=0)) / 2) * np.sign(w)
        u = fit[None, :] / diff
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        q[:, act] = q[:, act] @ u.T
        lam[act] = roots
    order = np.argsort(lam, kind="stable")
    return lam[order], q[:, order]


@dataclass
class Spectrum:
    """Count, mean, and the eigenpairs of the scatter about the mean."""

    n: int
    mean: np.ndarray
    lam: np.ndarray
    q: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> "Spectrum":
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def _shift(self, n: int, mean: np.ndarray) -> None:
        if self.n:
            gap = mean - self.mean
            self.lam, self.q = rank_one(self.lam, self.q, gap * np.sqrt(self.n / (self.n + n) * n))
            self.mean = self.mean + gap * (n / (self.n + n))
        else:
            self.mean = mean
        self.n += n

    def add_rows(self, x: np.ndarray) -> None:
        mean = x.mean(axis=0)
        rows = x - mean
        if len(rows) > 1:
            if len(rows) > rows.shape[1]:
                rows = np.linalg.qr(rows, mode="r")
            for v in rows:
                self.lam, self.q = rank_one(self.lam, self.q, v)
        self._shift(len(x), mean)

    def add(self, other: "Spectrum") -> None:
        for e, v in zip(other.lam, other.q.T, strict=True):
            if e > 0:
                self.lam, self.q = rank_one(self.lam, self.q, v * np.sqrt(e))
        self._shift(other.n, other.mean)

    def to_bytes(self) -> bytes:
        return np.concatenate([self.mean, self.lam, self.q.ravel()]).tobytes()

    @classmethod
    def from_bytes(cls, n: int, raw: bytes, dim: int) -> "Spectrum":
        a = np.frombuffer(raw, np.float64)
        return cls(n, a[:dim].copy(), a[dim:2 * dim].copy(), a[2 * dim:].reshape(dim, dim).copy())


# ------------------------------------------------------------------ distributed passes
def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums as Python integers."""
    if np.abs(x.astype(np.float64)).max(initial=0) * len(x) < 2.0 ** 62:
        return [int(s) for s in x.sum(axis=0)]
    return [sum(int(a) for a in col) for col in x.T]


def _first_pass(fit: DataFrame, dim: int, block: int, slots: int) -> dict | None:
    """n, exact sums, spectrum of the whole fit list."""
    schema = "n long, sums array<decimal(38,0)>, spectrum binary"

    def fold(batches):
        state, sums = Spectrum.empty(dim), [0] * dim
        for b in batches:
            x = V.matrix(b.column("x"), dim)
            for i in range(0, len(x), block):
                part = x[i:i + block]
                sums = [s + t for s, t in zip(sums, exact_sums(part), strict=True)]
                state.add_rows(part.astype(np.float64))
        return {"n": state.n, "sums": [Decimal(s) for s in sums], "spectrum": state.to_bytes()} if state.n else None

    def merge(rows):
        state, sums = Spectrum.from_bytes(rows[0]["n"], rows[0]["spectrum"], dim), [int(s) for s in rows[0]["sums"]]
        for r in rows[1:]:
            state.add(Spectrum.from_bytes(r["n"], r["spectrum"], dim))
            sums = [s + int(t) for s, t in zip(sums, r["sums"], strict=True)]
        return {"n": state.n, "sums": [Decimal(s) for s in sums], "spectrum": state.to_bytes()}

    return V.tree(V.partials(fit, schema, fold, slots), schema, merge, slots)


def _products(fit: DataFrame, mean: np.ndarray, basis: np.ndarray, slots: int) -> np.ndarray:
    """Mean of y y' over the fit list, y = basis' (x - mean)."""
    dim, k = basis.shape

    def fold(batches):
        total, seen = np.zeros((k, k)), False
        for b in batches:
            y = (V.matrix(b.column("x"), dim) - mean) @ basis
            total += y.T @ y
            seen = True
        return {"products": total.tobytes()} if seen else None

    def merge(rows):
        return {"products": np.sum([np.frombuffer(r["products"]) for r in rows], axis=0).tobytes()}

    got = V.tree(V.partials(fit, "products binary", fold, slots), "products binary", merge, slots)
    return np.frombuffer(got["products"]).reshape(k, k)


@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    basis: np.ndarray  # dim x components, unit columns
    explained: np.ndarray
    identity_error: float

    @property
    def positive(self) -> np.ndarray:
        return self.explained > 1e-12

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def fit(fit_list: DataFrame, dim: int, components: int = 4, block: int = 4096, passes: int = 4) -> Whitening | None:
    """Whitening of the rows of ``fit_list`` (a column x: array<long> of ``dim`` entries); None without rows."""
    slots = C.partitions(fit_list.sparkSession)
    first = _first_pass(fit_list, dim, block, slots)
    if first is None:
        return None
    n, sums = first["n"], [int(s) for s in first["sums"]]
    out = Whitening(n, sums, np.zeros(0), np.zeros((dim, 0)), np.zeros(0), 0.0)
    basis = np.linalg.qr(Spectrum.from_bytes(n, first["spectrum"], dim).q[:, ::-1])[0]  # many turns cost some orthogonality
    for _ in range(passes):
        h = _products(fit_list, out.mean, basis, slots) / n
        values, turn = np.linalg.eigh((h + h.T) / 2)
        basis, values = np.linalg.qr(basis @ turn[:, ::-1])[0], values[::-1]
        if np.abs(h - np.diag(np.diag(h))).max() <= 64 * EPS * np.abs(h).max():
            break
    k, trace = min(components, dim), float(np.trace(h))
    out.values, out.basis = values[:k], basis[:, :k]
    out.explained = out.values / trace if trace > 0 else np.zeros(k)
    ok = out.positive
    if ok.any():
        cov = _products(fit_list, out.mean, out.basis[:, ok] / np.sqrt(out.values[ok]), slots) / n
        out.identity_error = float(np.abs(cov - np.eye(ok.sum())).max())
    return out


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2, exactly; None beyond a long."""
    top = max(float(np.abs(x.astype(np.float64)).max(initial=0)) * n, max(abs(s) for s in sums)) * 2
    if top * top * x.shape[1] < 2.0 ** 62:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    wide = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return [w if w < 1 << 63 else None for w in wide]


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 4, block: int = 4096) -> DataFrame:
    """One row for each row of ``rows`` with a usable vector and each component, as in RESULT."""
    C.ship(rows.sparkSession)
    src, dim = V.usable(rows, vec_col, F.col(id_col).cast("long").alias("vec_id"))
    src = src.select("vec_id", V.scaled().alias("x"))
    if not dim:
        return src.sparkSession.createDataFrame([], RESULT)
    fit_list = C.saved(src.select("x").distinct(), "fit-list")
    model = fit(fit_list, dim, components, block)
    C.drop(fit_list)
    schema = C.arrow(V.struct_of(RESULT))
    k, ok, mean = len(model.values), model.positive, model.mean
    scale = model.basis / np.sqrt(np.where(ok, model.values, 1.0))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = V.matrix(b.column("x"), dim)
            w = (x - mean) @ scale
            rows_n = len(x)
            at = pa.array(np.repeat(np.arange(rows_n), k))
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_n)),
                pa.array(np.full(rows_n * k, model.n)), pa.array(deviations(x, model.n, model.sums), pa.int64()).take(at),
                pa.array(w.ravel(), mask=np.tile(~ok, rows_n)), pa.array(np.tile(model.explained, rows_n)),
                pa.array(np.full(rows_n * k, model.identity_error))], schema=schema)

    return src.mapInArrow(run, RESULT)
