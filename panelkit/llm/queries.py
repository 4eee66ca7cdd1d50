"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import (ann_graph, bitplane, cascade, cdc_bpe, hard_negatives, hd_langid, hyperminhash, pii_bootstrap, pu_quality,
                          recompress, warc_store, whitening, winnow)
from panelkit.llm import common as C

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bitplane(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = C.scratch(spark, "ids")
    bitplane.write_ids(C.table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return bitplane.read_docs(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op5_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = C.scratch(spark, "warc")
    warc_store.write_archive(C.table(spark, sf_dir, "pages"), path, revisit_bytes=1000)
    return warc_store.read_index(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op5_warc_store"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     m AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS d,
                  max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""


@query
def op2_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = cascade.apply_rules(C.table(spark, sf_dir, "documents"), report=base)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.select("doc_id", *base, failed.alias("base_failed"), "kept")


SQL["op2_cascade"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
     w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
     one AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, ws FROM w),
     word AS (SELECT doc_id, i, ws[i] AS word, array_to_string(ws[i : i + 4], ' ') AS win, i + 4 <= len(ws) AS whole FROM one),
     twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) > 1 AS again FROM word WHERE whole),
     hit AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest(range(5)) AS o) WHERE again GROUP BY 1),
     top AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, word, count(*) AS n FROM word GROUP BY 1, 2) GROUP BY 1),
     line AS (SELECT doc_id, count(*) AS n, count(DISTINCT x) AS u FROM
              (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY 1),
     m AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                  coalesce(line.n - line.u, 0)::BIGINT AS n_dup_lines, coalesce(line.n, 0) AS n_lines,
                  coalesce(hit.n, 0)::BIGINT AS n_repeat_words, coalesce(top.n, 0) AS top_word,
                  length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
                  length(regexp_replace(text, '[^A-Za-z\x{80}-\x{10FFFF}]', '', 'g')) AS n_letters
           FROM d JOIN w USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN line USING (doc_id)),
     b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 4 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 10 * n_upper > 7 * n_letters
            OR 10 * n_letters < 4 * word_chars OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * top_word > n_words) AS kept
FROM b
"""


@query
def op6_recompress(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = recompress.remove_repeats(C.table(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL["op6_recompress"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
     one AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, ws FROM w),
     word AS (SELECT doc_id, i, ws[i] AS word, array_to_string(ws[i : i + 12], ' ') AS win, i + 12 <= len(ws) AS whole FROM one),
     least AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS m FROM word WHERE whole),
     hit AS (SELECT DISTINCT doc_id, i + o AS i FROM least, (SELECT unnest(range(13)) AS o) WHERE m < doc_id),
     kept AS (SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.i) AS t, count(*) AS n
              FROM word LEFT JOIN hit ON hit.doc_id = word.doc_id AND hit.i = word.i WHERE hit.i IS NULL GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""


@query
def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hyperminhash.near_duplicates(C.table(spark, sf_dir, "documents"), width=4, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


SQL["op3_hyperminhash"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS ws FROM documents),
  one AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1)) + 1)) AS i, ws FROM w),
  s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS x FROM one),
  size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  link AS (SELECT a, b FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
  reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
  root AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN root USING (doc_id) LEFT JOIN size USING (doc_id)
"""


@query
def op10_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnow.decontaminate(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        winnow.contaminated().alias("contaminated"))


SQL["op10_winnow"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
     b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
     item AS (SELECT DISTINCT item_id, m, array_to_string(ws[i : i + m - 1], ' ') AS win FROM
              (SELECT item_id, ws, least(len(ws), 13) AS m, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS i FROM b WHERE len(ws) > 0)),
     doc AS (SELECT doc_id, m, i, array_to_string(ws[i : i + m - 1], ' ') AS win FROM
             (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (SELECT DISTINCT m FROM item) WHERE len(ws) >= m)),
     found AS (SELECT doc_id, doc.m, i, item_id FROM doc JOIN item ON doc.m = item.m AND doc.win = item.win),
     hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM found) GROUP BY 1),
     items AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS t FROM
               (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM found) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.t, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op8_cdc_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cdc_bpe.encode_documents(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def _fold(n: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(-1))


@query
def op7_hd_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    prototypes = hd_langid.learn(docs.where(_fold(3) != 1))
    out = hd_langid.predict(docs, prototypes)
    return out.select("doc_id", (_fold(3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op9_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = C.saved(pu_quality.measure(C.table(spark, sf_dir, "documents")), "measures")
    model = pu_quality.fit(measured, C.table(spark, sf_dir, "labels"), _fold(5) != 0)
    out = pu_quality.score(measured, model)
    return out.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op4_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    out = pii_bootstrap.report(docs, pii_bootstrap.find_spans(docs))
    return out.select("doc_id", *[f"n_{k}" for k in pii_bootstrap.KINDS],
                      F.sha2(F.array_join("base_spans", ",").cast("binary"), 256).alias("base_sha256"),
                      F.array_join("spans", ",").alias("spans"))


@query
def op11_secular_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(C.table(spark, sf_dir, "embeddings"), components=4)


@query
def op12_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(C.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label,
                               positives=5, negatives=5, low=80)


SQL["op12_kronecker_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
     s AS (SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
           FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
     p AS (SELECT anchor, other, score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other))::INTEGER AS rank,
       s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other) <= 5
"""


@query
def op13_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.table(spark, sf_dir, "embeddings")
    return ann_graph.search(ann_graph.build_index(rows), rows.where(F.col("vec_id") % 20 == 0), k=20)
