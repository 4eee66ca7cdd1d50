"""Rows and fixtures that the tests of this folder share."""

import random

import pytest


def prose(seed, n):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(1, 9))) for _ in range(400)]
    return [r.choice(vocabulary) + r.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n)]


def odd_rows():
    """doc_id, text: nulls, empty and long texts, ties, repeated rows, near copies, shared passages, odd characters."""
    base, passage = prose(1, 300), prose(2, 60)
    rows = [
        (1, None), (2, ""), (3, " \n\t \r"), (4, " ".join(prose(3, 20_000))), (5, "One two"), (6, "one TWO"), (7, "One two three four"),
        (10, " ".join(base)), (11, " ".join(base)), (11, " ".join(base)), (12, " ".join(base[:290])), (13, " ".join(base[10:] + prose(4, 6))),
        (14, " ".join(base).upper()), (20, " ".join(prose(5, 80) + passage + prose(6, 70))), (21, " ".join(prose(7, 30) + passage)),
        (22, " ".join(passage[:13])), (23, " ".join(passage[:12])), (24, " ".join(passage[20:33] + passage[40:55])),
        (30, "the " * 40), (31, "the " * 20), (32, "a b " * 30), (33, "b a " * 30),
        (40, "Straße é日本 😀 <|endoftext|> don't I'LL 12 345 ### |x| ÀÉ ß x İ \x85y"), (40, "another text under the same id " * 3),
        (41, "x" * 30_000), (42, "1.2.3.4 a@b.cc, +1 (017) 555-7713; 4111 1111 1111 1111 a@b.c_d@e.f.@g.h 999.1.1.1.1"),
        (43, "SHOUT! ALL! THE! WORDS! HERE! AND! THERE! AND! EVERY! WHERE! NOW!"), (44, "line of words\n" * 3 + "and more words to come here today"),
        (45, "a | b | c | d | e | f | g | h | i | j | k"), (None, " ".join(passage)), (None, "no id at all"),
    ]
    for i in range(12):  # a chain: each one is near the one before
        rows.append((60 + i, " ".join(prose(8, 200)[i * 8:] + prose(9, 100)[:i * 8])))
    return rows


@pytest.fixture(scope="session")
def odd():
    return odd_rows()


@pytest.fixture(scope="session")
def odd_docs(spark, odd):
    """The odd rows with further columns whose names the operators use themselves."""
    data = [(d, t, "x", 1.5, True, 7, "en", None) for d, t in odd]
    return spark.createDataFrame(
        data, "doc_id long, text string, tag string, n double, kept boolean, id int, lang string, blob string").repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, tag string")
