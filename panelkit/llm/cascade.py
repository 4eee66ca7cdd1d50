"""Quality rules as a short-circuit cascade.

A rule looks at measures of one text and says whether the text is to go.  A text is
kept if no rule rejects it, so the verdict does not depend on the order of the
rules; the work does.  ``plan`` runs all rules on a sample and estimates each
rule's cost (seconds a text, with the measures that only it needs) and the share it
rejects, and orders them by rejections per second.  ``apply_rules`` evaluates
them in that order and stops at the first rejection; measures are computed when a rule (or
the caller's list of columns) first asks for them.

Scale: two narrow passes over the texts, no shuffle; the plan is one row per rule.
Memory: one Arrow batch and one text's measures.

Defined cases: a null or empty text has no words, measures of 0, and is rejected by
``few_words``; repeated rows get equal results; very long texts are measured whole;
an empty table gives an empty result (and the rules' given order); columns of the
input that clash with the result's names are not carried.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm import common as C

BLANK = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))
LATER_BYTES = bytes(range(0x80, 0xC0))  # bytes that continue a code point
HIGH_BYTES = bytes(range(0x80, 0x100))


def repeated_words(words: list[bytes], k: int = 5) -> int:
    """Words that lie in windows of k words found twice or more (any of the occurrences)."""
    n = len(words)
    if n <= k:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    key, span, base = ids, 1, len(names)
    while span < k:  # exact names of longer windows: digits of a number while they fit, else ranks
        if base * len(names) >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            base = n
        key = key[:-1] * len(names) + ids[span:]
        base *= len(names)
        span += 1
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n - k + 1, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + k, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


class Measures:
    """Measures of one text, computed on demand."""

    def __init__(self, text: bytes):
        self.text = text

    def _without(self, chars: bytes) -> int:
        return len(self.text) - len(self.text.translate(None, chars))

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text.translate(None, BLANK + LATER_BYTES))

    @cached_property
    def n_symbols(self) -> int:
        return self._without(SYMBOLS)

    @cached_property
    def _lines(self) -> list[bytes]:
        return [x for x in self.text.split(b"\n") if x.strip(BLANK)]

    @cached_property
    def n_lines(self) -> int:
        return len(self._lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self._lines) - len(set(self._lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)

    @cached_property
    def n_upper(self) -> int:
        return self._without(UPPER)

    @cached_property
    def n_letters(self) -> int:
        """ASCII letters and all code points above ASCII."""
        return self._without(LETTERS) + self._without(HIGH_BYTES) - self._without(LATER_BYTES)

    @cached_property
    def top_word(self) -> int:
        """Occurrences of the most frequent word."""
        counts: dict[bytes, int] = {}
        for w in self.words:
            counts[w] = counts.get(w, 0) + 1
        return max(counts.values(), default=0)


#: name -> whether a text goes.  The first two are the base rules.
RULES: dict[str, Callable[[Measures], bool]] = {
    "few_words": lambda m: m.n_words < 10,
    "repeated_words": lambda m: 100 * m.n_repeat_words > 20 * m.n_words,
    "symbols": lambda m: 4 * m.n_symbols > m.n_words,
    "repeated_lines": lambda m: 2 * m.n_dup_lines > m.n_lines,
    "capitals": lambda m: 10 * m.n_upper > 7 * m.n_letters,
    "few_letters": lambda m: 10 * m.n_letters < 4 * m.word_chars,
    "word_length": lambda m: m.word_chars < 2 * m.n_words or m.word_chars > 20 * m.n_words,
    "one_word": lambda m: 2 * m.top_word > m.n_words,
}
BASE = ("few_words", "repeated_words")


def plan(docs: DataFrame, rules: dict[str, Callable] = RULES, fraction: float = 0.01, seed: int = 7) -> list[dict]:
    """Cost and selectivity of each rule on a sample (that share of all rows, so it grows with them), best
    rejections per second first: dicts of name, seconds (a text), rejected (share)."""
    C.ship(docs.sparkSession)
    schema = T.StructType([T.StructField("rule", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("hits", T.LongType()), T.StructField("ns", T.LongType())])
    out = C.arrow(schema)

    def measure(batches):
        n = 0
        hits, spent = dict.fromkeys(rules, 0), dict.fromkeys(rules, 0)
        for b in batches:
            for text in C.payloads(b, "text"):
                n += 1
                for name, rule in rules.items():
                    m = Measures(text)
                    began = time.perf_counter_ns()
                    hits[name] += bool(rule(m))
                    spent[name] += time.perf_counter_ns() - began
        yield C.batch(out, rule=list(rules), n=[n] * len(rules), hits=[hits[r] for r in rules], ns=[spent[r] for r in rules])

    sample = docs.select(F.col("text").cast("string").alias("text")).sample(fraction, seed)
    found = {r.rule: r for r in sample.mapInArrow(measure, schema).groupBy("rule")
             .agg(*[F.sum(c).alias(c) for c in ("n", "hits", "ns")]).collect()}
    said = [{"name": r, "seconds": found[r].ns / 1e9 / found[r].n, "rejected": found[r].hits / found[r].n}
            if r in found and found[r].n else {"name": r, "seconds": 0.0, "rejected": 0.0} for r in rules]
    return sorted(said, key=lambda x: -x["rejected"] / max(x["seconds"], 1e-12))


def _rejection(m: Measures, order: list[str], rules: dict[str, Callable]) -> tuple[str | None, int]:
    """The first rule that rejects, and how many were evaluated."""
    for tested, name in enumerate(order, 1):
        if rules[name](m):
            return name, tested
    return None, len(order)


def kept_rows(docs: DataFrame, order: list[str] | None = None, rules: dict[str, Callable] = RULES) -> DataFrame:
    """The rows of ``docs``, all columns, that no rule rejects."""
    C.ship(docs.sparkSession)
    order = order or [x["name"] for x in plan(docs, rules)]

    def keep(batches):
        for b in batches:
            mask = [_rejection(Measures(t), order, rules)[0] is None for t in C.payloads(b, "text")]
            yield b.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def apply_rules(docs: DataFrame, order: list[str] | None = None, rules: dict[str, Callable] = RULES,
                report: tuple[str, ...] = ("n_words",)) -> DataFrame:
    """doc_id, kept, rejected_by (the first rule in ``order`` that rejects; null if kept), n_tested (rules evaluated), and
    the measures named in ``report``, which are computed for every text."""
    C.ship(docs.sparkSession)
    order = order or [x["name"] for x in plan(docs, rules)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("kept", T.BooleanType()),
                           T.StructField("rejected_by", T.StringType()), T.StructField("n_tested", T.LongType()),
                           *[T.StructField(c, T.LongType()) for c in report]])
    out = C.arrow(schema)

    def judge(batches):
        for b in batches:
            rows = {f.name: [] for f in schema}
            for text in C.payloads(b, "text"):
                m = Measures(text)
                by, tested = _rejection(m, order, rules)
                rows["kept"].append(by is None)
                rows["rejected_by"].append(by)
                rows["n_tested"].append(tested)
                for c in report:
                    rows[c].append(getattr(m, c))
            yield C.batch(out, **(rows | {"doc_id": b.column("doc_id").to_pylist()}))

    return C.texts(docs).mapInArrow(judge, schema)
