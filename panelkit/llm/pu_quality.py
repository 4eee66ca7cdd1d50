"""Quality classifier from positive and unlabelled texts.

Trusted positives are texts with a good label; all others - without a label or with a bad one - are unlabelled.
A logistic model is fitted by the non-negative unbiased risk: with the share ``prior`` of good texts among the
unlabelled, the risk on negatives is that on the unlabelled less ``prior`` times that of positives called
negative; where this difference falls below 0 on a step, the step is reversed, so the model can't drive it down by overfitting.

The prior is estimated: a first model tells positives from unlabelled on one half of the sample; on the other half, the least
ratio of the shares above a threshold, unlabelled to positive, over thresholds that enough positives pass (with a confidence term), bounds it.

Scale: measures are taken in one narrow pass and kept; positives and unlabelled rows of the fit are
bounded samples (``fit_rows`` each, the rows of least hash, a parameter), everything else covers all rows.  Scoring is one narrow pass over the measures.

Defined cases: null or empty text has measures of 0 and gets a score; a doc_id labelled both ways counts as unlabelled; without positives or
without unlabelled rows the score is 0.5; repeated rows get equal scores; a null doc_id is scored and never learned from;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm import common as C
from panelkit.llm.cascade import Measures

MEASURED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
SCORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])
#: Borders of the steps into which each ratio is also cut.
STEPS = (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7)


def measures(text: bytes) -> list[float]:
    """log of the word count, the mean word length, and ratios between 0 and 1."""
    m = Measures(text)
    n, chars, lines = max(m.n_words, 1), max(m.word_chars, 1), max(m.n_lines, 1)
    size = max(len(text), 1)
    marks = len(text) - len(text.translate(None, b"!?"))
    digits = len(text) - len(text.translate(None, b"0123456789"))
    points = len(text) - len(text.translate(None, b".,;:"))
    return [
        float(np.log1p(m.n_words)), min(m.word_chars / n, 30.0) / 10,
        min(m.n_symbols / n, 3.0) / 3, m.n_dup_lines / lines, m.n_repeat_words / n, m.n_upper / max(m.n_letters, 1),
        1 - m.n_letters / chars if m.n_words else 0.0, m.top_word / n, len(set(m.words)) / n, min(marks / n, 2.0) / 2,
        digits / size, min(points / n, 1.0), len(set(text)) / 256,
    ]


def _inputs(x: np.ndarray) -> np.ndarray:
    """Measures, their squares, and steps of the ratios."""
    ratios = x[:, 2:]
    return np.hstack([x, x * x, *[(ratios > s).astype(float) for s in STEPS]])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class _Adam:
    def __init__(self, n: int, rate: float):
        self.w, self.m, self.v, self.t, self.rate = np.zeros(n), np.zeros(n), np.zeros(n), 0, rate

    def step(self, grad: np.ndarray):
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * grad
        self.v = 0.999 * self.v + 0.001 * grad * grad
        self.w = self.w - self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _risk_step(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float, ridge: float) -> np.ndarray:
    """Gradient of the non-negative risk under the logistic loss."""
    sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
    negative = -np.log(1 - su + 1e-12).mean() - prior * -np.log(1 - sp + 1e-12).mean()
    g_negative = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
    if negative < 0:  # beyond what any model can reach: undo
        return -g_negative
    return prior * (p.T @ (sp - 1)) / len(p) + g_negative + ridge * w


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 500, rate: float = 0.05, ridge: float = 1e-4) -> np.ndarray:
    model = _Adam(p.shape[1], rate)
    for _ in range(steps):
        model.step(_risk_step(model.w, p, u, prior, ridge))
    return model.w


def estimate_prior(p: np.ndarray, u: np.ndarray, steps: int = 300, shares=None) -> float:
    """Share of positives among ``u``."""
    model = _Adam(p.shape[1], 0.05)
    a, b = p[::2], u[::2]
    for _ in range(steps):
        grad = a.T @ (_sigmoid(a @ model.w) - 1) / len(a) + b.T @ _sigmoid(b @ model.w) / len(b)
        model.step(grad + 1e-4 * model.w)
    sp, su = np.sort(p[1::2] @ model.w), np.sort(u[1::2] @ model.w)
    if not len(sp) or not len(su):
        return 0.5
    at = np.unique(np.quantile(sp, np.linspace(0, 0.9, 91)))
    qp = 1 - np.searchsorted(sp, at) / len(sp)
    qu, n = shares(model.w, at) if shares else (1 - np.searchsorted(su, at) / len(su), len(su))
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(n))
    best = int(np.argmin((qu + slack) / np.maximum(qp, 1e-9)))
    return float(np.clip(qu[best] / qp[best], 0.02, 0.98))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, x (measures) for each row of ``docs``."""
    C.ship(docs.sparkSession)
    out = C.arrow(MEASURED)

    def run(batches):
        for b in batches:
            yield C.batch(out, doc_id=b.column("doc_id"), x=[measures(t) for t in C.payloads(b, "text")])

    return C.texts(docs).mapInArrow(run, MEASURED)


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])


def _summed(rows: DataFrame, values) -> np.ndarray:
    """Sum over all rows of ``values(inputs)``, an array of one row's numbers each: partial sums per batch, added by Spark."""
    out = C.arrow(T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", T.DoubleType())]))

    def run(batches):
        for b in batches:
            if b.num_rows:
                v = values(_inputs(np.array(b.column("x").to_pylist()))).sum(axis=0)
                yield C.batch(out, i=range(len(v)), v=v)

    got = rows.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()  # one row per number
    return np.array([r.v for r in sorted(got)])


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the inputs over all rows."""
    total = _summed(rows, lambda x: np.hstack([np.ones((len(x), 1)), x]))
    mean = total[1:] / total[0]
    return mean, np.sqrt(_summed(rows, lambda x: (x - mean) ** 2) / total[0]) + 1e-3


def _shares(rows: DataFrame, mean, scale, w, at) -> tuple[np.ndarray, int]:
    """Share of all rows whose score is at or above each threshold, and their number."""
    total = _summed(rows, lambda x: np.hstack([np.ones((len(x), 1)), (_scaled(x, mean, scale) @ w)[:, None] >= at[None, :]]))
    return total[1:] / total[0], int(total[0])


def fit(measured: DataFrame, labels: DataFrame, learnable: Column, fit_rows: int = 20_000) -> dict | None:
    """A model from the rows of ``measured`` for which ``learnable`` holds; ``labels`` has doc_id and quality (0, 1)."""
    good = (labels.select("doc_id", "quality").groupBy("doc_id").agg(F.min("quality").alias("least"))
            .select("doc_id", (F.col("least") == 1).alias("good")))
    rows = measured.where(F.col("doc_id").isNotNull() & learnable).join(good, "doc_id", "left")
    rows = rows.withColumn("good", F.coalesce("good", F.lit(False)))
    n = {r.good: r.n for r in rows.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return None
    # a sample by a hash threshold: about ``fit_rows`` rows reach the driver, whatever the number of partitions
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    samples = [np.array([r.x for r in rows.where((F.col("good") == g) & (draw < int(min(1.0, fit_rows / n[g]) * (1 << 31))))
                         .orderBy("doc_id", "x").select("x").collect()]) for g in (True, False)]
    if not all(len(s) for s in samples):
        return None
    unlabelled = rows.where(~F.col("good")).select("x")
    mean, scale = _moments(unlabelled)
    p, u = (_scaled(_inputs(s), mean, scale) for s in samples)
    prior = estimate_prior(p, u, shares=lambda w, at: _shares(unlabelled, mean, scale, w, at))
    return {"w": fit_nnpu(p, u, prior), "mean": mean, "scale": scale, "prior": prior}


def score(measured: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, score (estimated probability of a good text)."""
    out = C.arrow(SCORED)

    def run(batches):
        for b in batches:
            if model is None:
                yield C.batch(out, doc_id=b.column("doc_id"), score=[0.5] * b.num_rows)
            elif b.num_rows:
                x = _scaled(_inputs(np.array(b.column("x").to_pylist())), model["mean"], model["scale"])
                yield C.batch(out, doc_id=b.column("doc_id"), score=_sigmoid(x @ model["w"]))

    return measured.mapInArrow(run, SCORED)
