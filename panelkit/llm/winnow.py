"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are the runs of ASCII letters (lower-cased), digits and code points above ASCII.  A
window is ``size`` consecutive words of a benchmark item; an item with fewer words is one window of its own length.

Fingerprints: every run of ``k`` words is hashed and of each ``size - k + 1`` consecutive hashes the
smallest is kept, on both sides.  Two texts that share a span of ``size`` words share all hashes of that span and so its
minimum: a document with a window in it meets a fingerprint of the item for certain.  Short items are their own
fingerprint; documents then add their runs of the short lengths that occur (at most ``size - 1`` lengths).

Documents that meet any fingerprint are extended: all their windows are named by 128 bits and
looked up among the benchmark's windows; the words under matching windows are counted by merging their intervals.

Scale: fingerprints are taken in one narrow pass and kept (about a fifth of the words), so texts are read
twice and shuffled at most once, for the documents met.  The benchmark's tables are written before they are
joined, so the planner knows their true size: it broadcasts them below ``spark.sql.autoBroadcastJoinThreshold``
and shuffles both sides beyond.  Lookups are against distinct fingerprints and windows, so a passage that many items or
documents hold is never multiplied; only the pairs (document, item) that are part of the result are.

Defined cases: null or empty text has no words and is clean; null item text is no window; items that repeat an id
count once, an item without an id adds hits but is not counted; rows of one doc_id are told apart by a text hash and
repeated rows give repeated results; empty tables give no hits; further columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm import common as C

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(df: DataFrame) -> DataFrame:
    """Adds n (words) and hs (a 64-bit hash per word)."""
    lower = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    df = df.withColumn("ws", F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)))
    return df.withColumn("n", F.size("ws").cast("long")).withColumn("hs", F.transform("ws", lambda w: F.xxhash64(w)))


def _runs(col: str, m: int, salt: str = "") -> str:
    """SQL for the hashes of all runs of m words."""
    args = ", ".join([*([salt] if salt else []), *[f"{col}[i + {j}]" for j in range(m)]])
    return f"CASE WHEN n >= {m} THEN transform(sequence(0, CAST(n AS INT) - {m}), i -> xxhash64({args})) ELSE array() END"


def _fingerprints(df: DataFrame, size: int, k: int, short: list[int]) -> DataFrame:
    """Adds fps: the winnowed hashes, and the runs of the lengths in ``short``."""
    w = size - k + 1
    df = _words(df).withColumn("kg", F.expr(_runs("hs", k)))
    least = ", ".join(f"kg[i + {j}]" for j in range(w))
    mins = f"CASE WHEN n >= {size} THEN transform(sequence(0, size(kg) - {w}), i -> least({least})) ELSE CAST(array() AS array<bigint>) END"
    more = [_runs("hs", m, str(m)) for m in short]
    return df.withColumn("fps", F.expr(f"array_distinct({'concat(' + ', '.join([mins, *more]) + ')' if more else mins})"))


def _windows(df: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per window: the columns of ``df`` plus s, m (start and length) and h1, h2 (its name)."""
    kept = [c for c in df.columns if c != "text"]
    df = _words(df).withColumn("gs", F.transform("ws", lambda w: F.xxhash64(F.lit("second"), w)))
    parts = []
    for m in lengths:
        a, b = (", ".join(f"{c}[i + {j}]" for j in range(m)) for c in ("hs", "gs"))
        parts.append(f"CASE WHEN n >= {m} THEN transform(sequence(0, CAST(n AS INT) - {m}), i -> "
                     f"struct(i AS s, {m} AS m, xxhash64({m}, {a}) AS h1, xxhash64({b}, {m}) AS h2)) "
                     "ELSE CAST(array() AS array<struct<s: int, m: int, h1: bigint, h2: bigint>>) END")
    return df.select(*kept, F.explode(F.expr(f"concat({', '.join(parts)})")).alias("x")).select(*kept, "x.*")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 13, k: int = 5) -> DataFrame:
    """doc_id, tag (text hash), n_words, n_hit, item_ids (sorted strings of the items that occur) for each row of ``docs``."""
    src = C.texts(docs).withColumn("tag", F.xxhash64("text"))
    bench = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    counted = _words(bench).select("n").where("n > 0").select(F.least(F.col("n"), F.lit(size)).cast("int").alias("m")).distinct()
    lengths = sorted(r.m for r in counted.collect())  # at most ``size`` numbers
    short = [m for m in lengths if m < size]

    # (an outer explode: the planner would copy the array's expression into a filter below it)
    whole = _fingerprints(bench, size, k, []).select(F.explode_outer("fps").alias("fp")).where("fp is not null")
    for m in short:
        whole = whole.union(_words(bench).where(F.col("n") == m).select(F.explode(F.expr(_runs("hs", m, str(m)))).alias("fp")))
    wanted = C.saved(whole.distinct(), "item-prints")
    of_item = _words(bench).select("item_id", "text", F.least(F.col("n"), F.lit(size)).cast("int").alias("own"))
    windows = C.saved(_windows(of_item, lengths or [size]).where("m = own").select("h1", "h2", "item_id").distinct(), "item-windows")

    prints = C.saved(_fingerprints(src, size, k, short).select("doc_id", "tag", "n", "fps"), "prints")
    met = (prints.select("doc_id", "tag", F.explode("fps").alias("fp")).join(wanted, "fp", "left_semi")
           .select("doc_id", "tag").distinct())
    met = C.saved(met, "met")
    near = src.join(met.toDF("d", "t"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("t")), "left_semi").distinct()
    # one row for rows that repeat: the results are joined back to each
    hits = C.saved(_windows(near, lengths or [size]).join(windows.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi"), "hits")
    C.drop(met, wanted)

    span = Window.partitionBy("doc_id", "tag").orderBy("s", "m").rowsBetween(Window.unboundedPreceding, -1)
    gain = F.greatest(F.lit(0), F.col("s") + F.col("m") - F.greatest(F.col("s"), F.coalesce(F.max(F.col("s") + F.col("m")).over(span), F.lit(0))))
    covered = hits.select("doc_id", "tag", gain.cast("long").alias("g")).groupBy("doc_id", "tag").agg(F.sum("g").alias("n_hit"))
    pairs = hits.select("doc_id", "tag", "h1", "h2").distinct().join(windows, ["h1", "h2"]).select("doc_id", "tag", "item_id").distinct()
    listed = pairs.groupBy("doc_id", "tag").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    found = covered.join(listed.toDF("d", "t", "item_ids"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("t")))
    found = found.select(F.col("doc_id").alias("d"), F.col("tag").alias("t"), "n_hit", "item_ids")
    return prints.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("t")), "left").select(
        "doc_id", "tag", F.col("n").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def contaminated() -> F.Column:
    """A twentieth of the words or more are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean_rows(docs: DataFrame, items: DataFrame, size: int = 13, k: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    i, t = C.unused(docs, "bad_id"), C.unused(docs, "bad_tag")
    bad = decontaminate(docs, items, size, k).where(contaminated()).select(F.col("doc_id").alias(i), F.col("tag").alias(t))
    same = docs["doc_id"].cast("long").eqNullSafe(bad[i]) & (F.xxhash64(docs["text"].cast("string")) == bad[t])
    return docs.join(bad, same, "left_anti")
