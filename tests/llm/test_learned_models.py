"""Language profiles and the quality model against plain versions that go letter by letter and row by row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import hd_langid, pu_quality

TEXTS = [
    (1, "The quick brown fox, the lazy dog.", "en"), (2, "A dog and a fox met; the fox ran.", "en"), (3, "Der schnelle braune Fuchs und der Hund", "de"),
    (4, "Ein Fuchs läuft über die Straße", "de"), (5, "быстрая лиса и собака", "ru"), (6, "собака бежит домой", "ru"), (7, "the fox", None),
    (8, None, "en"), (9, "", "de"), (10, "12 + 34 = 46", "en"), (11, "x", None), (12, "𐐨𐐩 𐐪𐐫 the 日本語", "en"), (12, "der Hund, der Hund", "de"),
    (None, "лиса", None), (13, "Fuchs und Hund " * 40, None), (14, "the  dog\n\nand\tthe fox", "en"),
]


def plain_vector(text):
    """One trigram after the other; letters beside what is no letter see one blank."""
    half = hd_langid.LETTERS // 2
    ids = [0]
    for ch in (text or "").lower():
        cp = ord(ch)
        if not ch.isalpha():
            letter = 0
        elif cp > 0xFFFF:
            letter = half + cp % half
        else:
            letter = cp if cp < half else half + (cp * 40503 >> 4) % half
        if letter or ids[-1]:
            ids.append(letter)
    if ids[-1]:
        ids.append(0)
    signs = np.random.default_rng(20240217).integers(0, 2, (hd_langid.LETTERS, hd_langid.DIM), np.int8) * 2 - 1
    total = np.zeros(hd_langid.DIM)
    for a, b, c in zip(ids, ids[1:], ids[2:]):
        total += np.roll(signs[a], 2).astype(float) * np.roll(signs[b], 1) * signs[c]
    return total if len(ids) > 2 else None


def test_language_profiles_equal_the_plain_version(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string").repartition(3)
    got = {(r.doc_id, r.text): (r.lang_pred, r.score)
           for r in hd_langid.predict(docs, hd_langid.learn(docs)).join(docs.select("doc_id", "text").distinct(), "doc_id").collect() if r.doc_id not in (None, 12)}
    sums = {}
    for _, text, lang in TEXTS:
        v = plain_vector(text) if text is not None else None
        if v is not None and lang is not None:
            sums[lang] = sums.get(lang, 0) + v / np.linalg.norm(v)
    names = sorted(sums)
    unit = np.stack([sums[k] / np.linalg.norm(sums[k]) for k in names])
    centre = unit.mean(axis=0)
    for doc, text, _ in TEXTS:
        if doc in (None, 12):  # two rows of one id, and none: judged apart below
            continue
        v = plain_vector(text)
        if v is None:
            assert got[doc, text] == ("und", 0.0)
            continue
        v = v / np.linalg.norm(v) - centre
        cosines = [float(v @ (p - centre) / np.linalg.norm(v) / np.linalg.norm(p - centre)) for p in unit]
        said, score = got[doc, text]
        assert said == names[int(np.argmax(cosines))] and score == pytest.approx(min(max(max(cosines), 0.0), 1.0), abs=1e-5)
    twice = sorted(r.lang_pred for r in hd_langid.predict(docs.where("doc_id = 12"), hd_langid.learn(docs)).collect())
    assert twice == ["de", "en"]
    assert hd_langid.predict(docs.where("doc_id is null"), hd_langid.learn(docs)).first().lang_pred == "ru"


def sigmoid(z):
    return 1 / (1 + np.exp(-z))


def descend(gradient, width, steps):
    """Adam, one weight vector."""
    w = first = second = np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(w)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g ** 2
        w = w - 0.05 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    return w


def plain_model(good, rest):
    """Prior and weights by sums over rows, from inputs of the positives and the unlabelled."""
    mean = sum(rest) / len(rest)
    scale = np.sqrt(sum((x - mean) ** 2 for x in rest) / len(rest)) + 1e-3
    p, u = ([np.append(np.clip((x - mean) / scale, -8, 8), 1.0) for x in rows] for rows in (good, rest))

    def split(w):
        return (sum(x * (sigmoid(x @ w) - 1) for x in p[::2]) / len(p[::2]) + sum(x * sigmoid(x @ w) for x in u[::2]) / len(u[::2]) + 1e-4 * w)

    w = descend(split, len(p[0]), 300)
    seen, every = [x @ w for x in p[1::2]], [x @ w for x in u]
    least, prior = None, None
    for at in np.unique(np.quantile(seen, np.linspace(0, 0.9, 91))):
        q, r = np.mean([s >= at for s in seen]), np.mean([s >= at for s in every])
        bound = (r + np.sqrt(np.log(40) / 2) * (len(seen) ** -0.5 + len(every) ** -0.5)) / q
        if least is None or bound < least:
            least, prior = bound, min(max(r / q, 0.02), 0.98)

    def risk(w):
        on_u = sum(-np.log(1 - sigmoid(x @ w) + 1e-12) for x in u) / len(u)
        on_p = sum(-np.log(1 - sigmoid(x @ w) + 1e-12) for x in p) / len(p)
        negative = sum(x * sigmoid(x @ w) for x in u) / len(u) - prior * sum(x * sigmoid(x @ w) for x in p) / len(p)
        if on_u - prior * on_p < 0:
            return -negative
        return prior * sum(x * (sigmoid(x @ w) - 1) for x in p) / len(p) + negative + 1e-4 * w

    return prior, descend(risk, len(p[0]), 500), mean, scale


def test_quality_model_equals_the_plain_version(spark):
    rng = np.random.default_rng(8)
    words = ["alpha", "beta", "gamma", "Delta", "eps", "a", "of", "the", "1234", "###", "buy!!!", "NOW"]
    rows, labels = [], []
    for i in range(48):
        fine = i % 2 == 0
        n = int(rng.integers(15, 60))
        pick = rng.integers(0, 8, n) if fine else rng.integers(5, 12, n)
        rows.append((i, " ".join(words[k] for k in pick)))
        if i % 4 == 0 or i % 6 == 1:
            labels.append((i, int(fine)))
    labels += [(2, 1), (2, 0)]  # labelled both ways: unlabelled
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    measured = pu_quality.measure(docs)
    model = pu_quality.fit(measured, known, F.col("doc_id") % 5 != 0)

    def inputs(text):
        x = np.array(pu_quality.measures(text.encode()))
        return np.concatenate([x, x * x, *[[float(v > s) for v in x[2:]] for s in pu_quality.STEPS]])

    trusted = {d for d, q in labels if q == 1 and (d, 0) not in labels}
    good = [inputs(t) for d, t in rows if d % 5 and d in trusted]
    rest = [inputs(t) for d, t in rows if d % 5 and d not in trusted]
    prior, w, mean, scale = plain_model(good, rest)
    assert model["prior"] == pytest.approx(prior, abs=1e-9)
    got = {r.doc_id: r.score for r in pu_quality.score(measured, model).collect()}
    for d, text in rows:
        x = np.append(np.clip((inputs(text) - mean) / scale, -8, 8), 1.0)
        assert got[d] == pytest.approx(sigmoid(x @ w), abs=1e-5)
