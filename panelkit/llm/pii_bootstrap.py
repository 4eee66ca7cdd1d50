"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Base: e-mail addresses, IPv4 addresses, payment cards and phone numbers are found by the patterns below (leftmost, not overlapping
within a kind) and validated; a match that fails is dropped and not retried.  Offsets are code points.

Bootstrapping: base spans are the seeds.  The word before an entity and the word after it are lexical patterns for its kind; a pattern's
instances are the values beside it.  Candidates are other tokens with digits or an @, and groups of digits with single blanks between them,
whose shape could be of the kind.
In each round a pattern's confidence is the sum of its instances' scores, each counted at every place where it stands beside the word, over *all*
places where its word occurs in the corpus, so that a word which stands beside anything at all says nothing and copies change nothing.
An instance's score is the noisy-or of its patterns' confidences (seeds stay at 1).  Patterns need ``support`` different seeds.
After ``rounds`` rounds the candidates that score at least ``accept`` are added, under
the best kind; they never replace or touch a base span.

Scale: matching is one narrow pass over the texts and yields rows for matches alone; offsets come from running sums per document.  The corpus'
words are counted with map-side aggregation.  Patterns, instances and their edges are aggregated and joined on their keys, so
a pattern in a third of all documents is a pre-aggregated key.  Nothing is collected or hinted to broadcast.

Defined cases: null or empty text has no spans; rows of one doc_id are told apart by a text hash, repeated rows get equal
results; very long texts and tokens are matched whole in linear time (the patterns are anchored at the start of their runs and do not
backtrack); only a candidate's context is bounded (``context`` characters); empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm import common as C

KINDS = ("email", "ip", "card", "phone")
#: The stated patterns; possessive, and anchored where an earlier start in the same run would do as well.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Non-space runs with a digit or an @.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Digit groups with single blanks between them.
GROUPS = r"(?<!\S)[+(]*+[0-9][0-9().-]*+(?: [(]?+[0-9][0-9().-]*+)++(?![A-Za-z0-9@_/])"
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: What an unseen value of a kind must look like.
SHAPES = {
    "email": r"^[^@\s]+(?:@|\[at\]|\(at\))[^@\s]+$", "ip": r"^[0-9]+(?:[.:][0-9]+){3,}$",
    "card": r"^[0-9](?:[ -]?[0-9]){11,18}$", "phone": r"^[+(]?[0-9](?:[() .-]*+[0-9]){6,14}$",
}
EDGE_MARKS = "\"'()[]{}<>,;:!?*$%&#|."


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """At most 19 digits pass the check (leading zeros don't matter)."""
    padded, total = F.lpad(digits, 19, "0"), F.lit(0)
    for i in range(19):
        d = F.substring(padded, i + 1, 1).cast("int")
        if (18 - i) % 2:
            d = 2 * d - F.when(d > 4, 9).otherwise(0)
        total = total + d
    return total % 10 == 0


def _valid(kind: Column, m: Column) -> Column:
    digits = _digits(m)
    n = F.length(digits)
    return (F.when(kind == "ip", m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
            .when(kind == "card", n.between(13, 19) & F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(9, 15)).otherwise(True))


def _matches(src: DataFrame, patterns: dict[str, str], context: int) -> DataFrame:
    """One row per match, before validation: doc_id, tag, kind, i, value, s, e (code points), left and right (the words before and after it), copies (equal rows)."""
    found = F.array(*[F.struct(F.lit(k).alias("kind"), F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias("ms"), F.lit(n).alias("n"))
                      for n, (k, p) in enumerate(patterns.items())])
    # explode_outer and the later filter: the planner would otherwise repeat the matching in a filter below
    rows = src.select("doc_id", "tag", "text", F.explode_outer(found).alias("x")).where(F.size("x.ms") > 0)
    between = F.lit(None).cast("array<string>")
    for k, p in patterns.items():
        between = F.when(F.col("x.kind") == k, F.split("text", p, -1)).otherwise(between)
    rows = rows.select("doc_id", "tag", F.col("x.kind").alias("kind"), F.col("x.ms").alias("ms"), between.alias("gaps"))
    n = F.size("ms")
    each = F.arrays_zip(F.col("ms").alias("m"), F.slice("gaps", 1, n).alias("g"), F.slice("gaps", 2, n).alias("h"))
    rows = rows.select("doc_id", "tag", "kind", F.posexplode_outer(each).alias("i", "y")).select(
        "doc_id", "tag", "kind", "i", F.col("y.m").alias("value"), F.length("y.g").alias("gap"), F.expr(f"right(y.g, {context})").alias("before"),
        F.expr(f"left(y.h, {context})").alias("after"))
    # repeated rows once, with their number
    rows = rows.groupBy("doc_id", "tag", "kind", "i").agg(
        *[F.first(c).alias(c) for c in ("value", "gap", "before", "after")], F.count(F.lit(1)).alias("copies"))
    upto = Window.partitionBy("doc_id", "tag", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    return rows.withColumn("e", end).select(
        "doc_id", "tag", "kind", "i", "value", (F.col("e") - F.length("value")).alias("s"), "e",
        F.lower(F.regexp_extract("before", r"(\S+)\s+$", 1)).alias("left"),
        F.lower(F.regexp_extract("after", r"^\s+(\S+)", 1)).alias("right"), "copies")


def _trimmed(rows: DataFrame) -> DataFrame:
    """Candidates without the marks at their edges."""
    marks = "".join("\\" + c for c in EDGE_MARKS)
    head = F.length(F.regexp_extract("value", f"^[{marks}]*+", 0))
    core = F.regexp_extract("value", rf"^[{marks}]*+(.*?)[{marks}]*$", 1)
    return rows.withColumn("head", head).withColumn("core", core).select(
        "doc_id", "tag", (F.col("s") + F.col("head")).alias("s"), (F.col("s") + F.col("head") + F.length("core")).alias("e"),
        F.col("core").alias("value"), "left", "right", "copies").where("value <> ''")


def _word_counts(src: DataFrame) -> DataFrame:
    """(word, total): how often each word occurs, lower-cased, between white space."""
    return (src.select(F.explode(F.split(F.lower("text"), r"\s+")).alias("word")).where("word <> ''")
            .groupBy("word").agg(F.count(F.lit(1)).alias("total")))


def _edges(rows: DataFrame) -> DataFrame:
    """(kind, side, word, value, n): the values beside each word, and at how many places."""
    sides = F.array(*[F.struct(F.lit(x).alias("side"), F.col(x).alias("word")) for x in ("left", "right")])
    rows = rows.select("kind", F.lower("value").alias("value"), "copies", F.explode(sides).alias("x"))
    return rows.where("x.word <> ''").groupBy("kind", "x.side", "x.word", "value").agg(F.sum("copies").alias("n"))


def _discovered(src: DataFrame, base: DataFrame, context: int, rounds: int, support: int, accept: float) -> tuple[DataFrame, list[DataFrame]]:
    """Spans (doc_id, tag, kind, s, e) that bootstrapping adds, and the scratch tables that they are read from."""
    tokens = _trimmed(_matches(src, {"any": CANDIDATE, "groups": GROUPS}, context))
    kinds = F.array(*[F.when(F.col("value").rlike(p), F.lit(k)) for k, p in SHAPES.items()])
    tokens = tokens.select("*", F.explode(F.array_compact(kinds)).alias("kind"))
    # outside every base span: none starts or ends within the token, and none covers it
    b = base.select(F.col("doc_id").alias("d"), F.col("tag").alias("t"), F.col("s").alias("bs"), F.col("e").alias("be"))
    clash = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("t")) & (F.col("bs") < F.col("e")) & (F.col("s") < F.col("be"))
    tokens = C.saved(tokens.join(b, clash, "left_anti"), "candidates")  # all: only learning needs a word beside them

    seeds = _edges(base)  # counted over the same rows as a word's total
    able = seeds.groupBy("kind", "side", "word").agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= support).drop("seeds")
    # an inner join: a semi join would be pushed below the count and shuffle every word of the corpus
    patterns = C.saved(able.join(_word_counts(src), "word"), "patterns")
    edges = seeds.withColumn("seed", F.lit(True)).unionByName(_edges(tokens).withColumn("seed", F.lit(False)))
    edges = edges.groupBy("kind", "side", "word", "value").agg(F.max("seed").alias("seed"), F.sum("n").alias("n"))
    edges = C.saved(edges.join(patterns, ["kind", "side", "word"]), "edges")

    made = [tokens, patterns, edges]
    scores = edges.groupBy("kind", "value").agg(F.max("seed").alias("seed")).withColumn("score", F.col("seed").cast("double"))
    for _ in range(rounds):
        trust = (edges.drop("seed").join(scores, ["kind", "value"]).groupBy("kind", "side", "word")
                 .agg((F.sum(F.col("n") * F.col("score")) / (F.max("total") + 1)).alias("trust")))
        miss = F.sum(F.log1p(-F.least(F.col("trust"), F.lit(0.999999))))
        scores = (edges.join(trust, ["kind", "side", "word"]).groupBy("kind", "value").agg(F.max("seed").alias("seed"), (1 - F.exp(miss)).alias("or"))
                  .select("kind", "value", "seed", F.when(F.col("seed"), 1.0).otherwise(F.col("or")).alias("score")))
        scores = C.saved(scores, "scores")
        made.append(scores)
    good = scores.where(~F.col("seed") & (F.col("score") >= accept)).select("kind", F.col("value").alias("v"), "score")
    rank = F.struct(F.col("score"), (-F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))).alias("order"))
    # of a value's kinds the best
    chosen = good.groupBy("v").agg(F.max_by("kind", rank).alias("kind"))
    return tokens.withColumn("v", F.lower("value")).join(chosen, ["v", "kind"], "left_semi").select("doc_id", "tag", "kind", "s", "e"), made


def find_spans(docs: DataFrame, context: int = 64, rounds: int = 3, support: int = 3, accept: float = 0.6) -> DataFrame:
    """One row per span: doc_id, tag (text hash), kind, s, e (code points, end exclusive), base (found by the stated patterns)."""
    src = C.texts(docs).withColumn("tag", F.xxhash64("text"))
    base = _matches(src, PATTERNS, context)
    base = C.saved(base.where(_valid(F.col("kind"), F.col("value"))).drop("i"), "base")
    more, made = _discovered(src, base, context, rounds, support, accept)
    spans = C.saved(base.select("doc_id", "tag", "kind", "s", "e", F.lit(True).alias("base"))
                    .union(more.withColumn("base", F.lit(False))), "spans")
    C.drop(base, *made)
    return spans


def _order() -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))


def _per_row(docs: DataFrame, found: DataFrame, kept: list[str]) -> DataFrame:
    """``docs`` (with tag) joined with one row per (doc_id, tag)."""
    found = found.withColumnsRenamed({"doc_id": "d", "tag": "t"})
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("t")), "left").select(*kept, *[c for c in found.columns if c not in ("d", "t")])


def report(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_<kind> (base spans), base_spans and spans (arrays of "kind:start:end" by kind, then start)."""
    said = F.struct(_order().alias("o"), "s", "e", F.concat_ws(":", "kind", F.col("s").cast("string"), F.col("e").cast("string")).alias("x"))
    per = spans.groupBy("doc_id", "tag").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS],
        F.array_sort(F.collect_list(F.when(F.col("base"), said))).alias("b"), F.array_sort(F.collect_list(said)).alias("a"))
    src = C.texts(docs).select("doc_id", F.xxhash64("text").alias("tag"))
    none = F.array().cast("array<string>")
    return _per_row(src, per, ["doc_id"]).select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.coalesce("b.x", none).alias("base_spans"), F.coalesce("a.x", none).alias("spans"))


def redact(docs: DataFrame, spans: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; of overlapping spans the union is replaced, under the first one's kind."""
    upto = Window.partitionBy("doc_id", "tag").orderBy("s", "e", "kind").rowsBetween(Window.unboundedPreceding, -1)
    upto_now = Window.partitionBy("doc_id", "tag").orderBy("s", "e", "kind")
    runs = spans.withColumn("fresh", F.coalesce(F.col("s") >= F.max("e").over(upto), F.lit(True)))
    runs = runs.withColumn("run", F.sum(F.col("fresh").cast("long")).over(upto_now))
    runs = runs.groupBy("doc_id", "tag", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min_by("kind", F.struct("s", "e", "kind")).alias("kind"))
    at = C.unused(docs, "span_runs")
    own_id, own_tag = F.col(C.unused(docs, "span_id")), F.col(C.unused(docs, "span_tag"))
    per = runs.groupBy("doc_id", "tag").agg(F.array_sort(F.collect_list(F.struct("s", "e", "kind"))).alias(at))
    per = per.select(F.col("doc_id").alias(C.unused(docs, "span_id")), F.col("tag").alias(C.unused(docs, "span_tag")), at)
    both = docs.join(per, docs["doc_id"].cast("long").eqNullSafe(own_id) & (F.xxhash64(docs[text_col].cast("string")) == own_tag), "left")
    text = f"`{text_col}`"
    pieces = F.expr(f"""transform({at}, (x, i) -> concat(
        substring({text}, CAST(if(i = 0, 0, element_at({at}, i).e) + 1 AS INT), CAST(x.s - if(i = 0, 0, element_at({at}, i).e) AS INT)),
        '<', upper(x.kind), '>'))""")
    rest = F.expr(f"substring({text}, CAST(element_at({at}, -1).e + 1 AS INT))")
    clean = F.when(F.size(at) > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col(text_col))
    return both.withColumn(text_col, clean).select(*docs.columns)
