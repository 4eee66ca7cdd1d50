"""Language identification by hyperdimensional profiles.

Every letter has a random vector of -1 and 1 in ``DIM`` dimensions, drawn from a fixed seed.  Three letters in a row
are bound into one vector: the first one's vector rotated twice, times the second one's rotated once, times the third
one's.  A text's vector is the bundle (sum) of its trigrams' vectors; white space and other non-letters
count as one blank between words.  A language's prototype bundles the unit vectors of its texts, so that a long text counts no
more than a short one.  A text gets the language of the nearest prototype by cosine, after the mean of all prototypes is taken
off both (what the languages have in common says nothing).

Scale: learning adds one vector per task and language, summed by dimension; only prototypes (languages x DIM numbers) reach
the driver.  Prediction is one narrow pass.  Sums are of whole numbers and don't depend on their order.

Defined cases: null text, or text without a letter, is ``und`` with score 0; any single letter can be scored; without
learned rows all is ``und``; equal cosines go to the smaller language name; repeated rows give equal results; further columns
are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm import common as C

DIM = 1024
LETTERS = 2048  # ids: code points below half of it, others hashed into the upper half
UNIT = 1 << 20
SUMS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("sums", T.ArrayType(T.LongType())), T.StructField("n", T.LongType())])
SAID = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_KEPT: dict[str, tuple] = {}


def _letter_vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of a trigram's first, second and third letter."""
    if "letters" not in _KEPT:
        v = np.random.default_rng(20240217).integers(0, 2, (LETTERS, DIM), np.int8) * 2 - 1
        v = v.astype(np.int8)
        _KEPT["letters"] = (np.roll(v, 2, axis=1), np.roll(v, 1, axis=1), v)
    return _KEPT["letters"]


def _alphabet() -> np.ndarray:
    """Letter id of each code point of the basic plane; 0 for all that is no letter."""
    if "ids" not in _KEPT:
        cp = np.arange(1 << 16)
        alpha = np.array([chr(c).isalpha() for c in range(1 << 16)])
        ids = np.where(cp < LETTERS // 2, cp, LETTERS // 2 + (cp * 40503 >> 4) % (LETTERS // 2))
        _KEPT["ids"] = (np.where(alpha, ids, 0).astype(np.int64),)
    return _KEPT["ids"][0]


def letters_of(text: str) -> np.ndarray:
    """Letter ids of a text with one 0 between words and at both ends; only [0] where it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    table = _alphabet()
    ids = table[np.minimum(points, 0xFFFF)]
    far = points > 0xFFFF
    if far.any():
        alpha = np.fromiter((chr(p).isalpha() for p in points[far]), bool, int(far.sum()))
        ids[far] = np.where(alpha, LETTERS // 2 + points[far].astype(np.int64) % (LETTERS // 2), 0)
    ids = np.concatenate([[0], ids, [0]])
    return ids[np.append(True, (ids[1:] != 0) | (ids[:-1] != 0))]


def text_vector(text: str) -> np.ndarray | None:
    """The bundle of a text's trigrams; None where it has no letter."""
    ids = letters_of(text)
    if len(ids) < 3:
        return None
    grams, counts = np.unique((ids[:-2] * LETTERS + ids[1:-1]) * LETTERS + ids[2:], return_counts=True)
    a, b, c = _letter_vectors()
    out = np.zeros(DIM, np.float32)
    for i in range(0, len(grams), 4096):  # bounded memory for texts with very many trigrams
        g = grams[i:i + 4096]
        bound = a[g // LETTERS**2] * b[g // LETTERS % LETTERS] * c[g % LETTERS]
        out += counts[i:i + 4096].astype(np.float32) @ bound.astype(np.float32)
    return out


def learn(docs: DataFrame) -> dict[str, np.ndarray]:
    """Prototypes (unit bundles) of the languages in ``docs`` (text, lang); rows without either are left out."""
    C.ship(docs.sparkSession)
    out = C.arrow(SUMS)

    def bundle(batches):
        sums: dict[str, list] = {}
        for b in batches:
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                v = text_vector(text)
                if v is not None and v.any():
                    s = sums.setdefault(lang, [np.zeros(DIM, np.int64), 0])
                    s[0] += np.rint(v / np.linalg.norm(v) * UNIT).astype(np.int64)
                    s[1] += 1
        yield C.batch(out, lang=list(sums), sums=[s[0].tolist() for s in sums.values()], n=[s[1] for s in sums.values()])

    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    # longs of UNIT scale: 2^43 texts fit
    parts = rows.mapInArrow(bundle, SUMS).select("lang", F.posexplode("sums").alias("dim", "v"))
    got = parts.groupBy("lang", "dim").agg(F.sum("v").alias("v")).collect()
    prototypes: dict[str, np.ndarray] = {}
    for r in got:
        prototypes.setdefault(r.lang, np.zeros(DIM))[r.dim] = r.v
    return {k: prototypes[k] / max(np.linalg.norm(prototypes[k]), 1e-300) for k in sorted(prototypes)}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score (the cosine, 0 at least) for each row of ``docs`` (doc_id, text)."""
    C.ship(docs.sparkSession)
    out = C.arrow(SAID)
    names = sorted(prototypes)
    table = np.stack([prototypes[k] for k in names]) if names else np.zeros((0, DIM))
    mean = table.mean(axis=0) if len(names) > 1 else np.zeros(DIM)
    table = table - mean
    table = table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-300)

    def judge(batches):
        for b in batches:
            said, score = [], []
            for text in b.column("text").to_pylist():
                v = text_vector(text) if text and names else None
                if v is None:
                    said.append("und")
                    score.append(0.0)
                    continue
                v = v / max(np.linalg.norm(v), 1e-30) - mean
                cosine = table @ v / max(np.linalg.norm(v), 1e-30)
                best = int(np.argmax(cosine))
                said.append(names[best])
                score.append(float(min(max(cosine[best], 0.0), 1.0)))
            yield C.batch(out, doc_id=b.column("doc_id"), lang_pred=said, score=score)

    return C.texts(docs).mapInArrow(judge, SAID)
