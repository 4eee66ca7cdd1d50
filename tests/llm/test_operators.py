"""Each operator against a plain-Python version on odd rows, and on an empty table."""

import random

import numpy as np
import public_tokenizers
import pytest
from brute import (base_measures, bpe, contamination, kept_words, near_duplicates, pii, redacted, rule_rejects,
                   shingle_set, token_rows, words)
from llm_fixtures import no_docs, odd, odd_docs, prose  # noqa: F401
from pyspark.sql import functions as F

from panelkit.llm import bitplane, cascade, cdc_bpe, hd_langid, hyperminhash, pii_bootstrap, pu_quality, recompress, warc_store, winnow
from panelkit.llm import common as C

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def key(row):
    return tuple((x is None, str(x)) for x in row)


def same(got, expected):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, expected), key=key)


# 1 ---------------------------------------------------------------------------------------------
@pytest.mark.parametrize("layout,block", [("byte", 1 << 16), ("bit", 500)])
def test_bitplane_round_trip(spark, odd, odd_docs, layout, block):
    path = C.scratch(spark, "t")
    bitplane.write_ids(odd_docs, path, WORD_BPE, layout=layout, block_ids=block)
    got = bitplane.read_docs(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    exp = token_rows(odd, "word_bpe_49k.json", 1)
    single = {d for d, _ in odd if d is not None} - {11, 40}
    same([r for r in got if r.doc_id in single], [r for r in exp if r[0] in single])
    same([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], [(r[0], r[2], r[3]) for r in exp])  # ties: any order among them
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_bitplane_planes_and_damage():
    ids = np.random.default_rng(1).integers(0, 2**32, 1001, np.uint32)
    for layout in ("byte", "bit"):
        assert (bitplane.ids_of(bitplane.planes_of(ids, layout), 1001, layout) == ids).all()
    import zlib
    assert bitplane.crc32_join(zlib.crc32(b"abc"), zlib.crc32(b"defgh"), 5) == zlib.crc32(b"abcdefgh")
    with pytest.raises(ValueError):
        import zstandard
        planes = [zstandard.compress(p) for p in bitplane.planes_of(ids, "byte")]
        bitplane.decode_block({"planes": planes, "n_ids": 1001, "layout": "byte", "crc32": 1, "shard": 0, "block": 0})


# 2 ---------------------------------------------------------------------------------------------
def test_cascade(odd, odd_docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for order in (list(cascade.RULES), list(cascade.RULES)[::-1], None):
        got = cascade.apply_rules(odd_docs, order, report=names).select("doc_id", *names, "kept").collect()
        same(got, [(d, *base_measures(t), not rule_rejects(t)) for d, t in odd])
    kept = cascade.kept_rows(odd_docs)
    assert kept.columns == odd_docs.columns
    same(kept.select("doc_id", "text").collect(), [r for r in odd if not rule_rejects(r[1])])


def test_cascade_order(spark):
    docs = spark.createDataFrame([(i, "THE " * 30 if i % 2 else " ".join(prose(i, 60))) for i in range(60)], "doc_id long, text string")
    said = cascade.plan(docs, fraction=1.0)
    rates = [x["rejected"] / max(x["seconds"], 1e-12) for x in said]
    assert rates == sorted(rates, reverse=True) and {x["name"] for x in said} == set(cascade.RULES)
    assert next(x for x in said if x["name"] == "one_word")["rejected"] == 0.5
    assert cascade.apply_rules(docs, ["one_word", "few_words"]).where("kept").agg(F.max("n_tested")).first()[0] == 2


# 3 ---------------------------------------------------------------------------------------------
@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(odd, odd_docs, width):
    roots = near_duplicates(odd, width)
    got = hyperminhash.near_duplicates(odd_docs, width=width).collect()
    same(got, [(d, len(shingle_set(t, width)), roots.get(d), d is None or roots[d] == d) for d, t in odd])
    assert sum(r.kept for r in got) < len(got)
    stay = hyperminhash.one_of_each(odd_docs, width=width)
    assert stay.columns == odd_docs.columns
    same(stay.select("doc_id").collect(), [(d,) for d, _ in odd if d is None or roots[d] == d])


def test_near_duplicates_block_round(odd, odd_docs):
    """Without a star round the blocks alone find every link."""
    roots = near_duplicates(odd, 4)
    got = hyperminhash.near_duplicates(odd_docs, width=4, centres=0).collect()
    same([(r.doc_id, r.component_id) for r in got], [(d, roots.get(d)) for d, _ in odd])


def test_sketch_estimates_similarity():
    r = random.Random(5)
    for share in (0.5, 0.8, 0.95):
        n = 3000
        common = int(2 * n * share / (1 + share))
        base = [r.getrandbits(64) for _ in range(2 * n)]
        a, b = base[:n], base[n - common:2 * n - common]
        regs = hyperminhash.sketches(np.array(a + b, np.uint64), np.repeat([0, 1], n), 2)
        assert abs(float(hyperminhash.estimate((regs[0] == regs[1]).sum())) - share) < 0.15


# 4 ---------------------------------------------------------------------------------------------
def test_pii_base(odd, odd_docs):
    got = pii_bootstrap.report(odd_docs, pii_bootstrap.find_spans(odd_docs)).collect()
    exp = []
    for d, t in odd:
        found = pii(t)
        exp.append((d, *[sum(k == x[0] for x in found) for k in pii_bootstrap.KINDS], ["%s:%d:%d" % x for x in found]))
    same([(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_spans) for r in got], exp)


def test_pii_discovers_and_redacts(spark):
    rows = [(i, f"some text then contact: user{i}@mail.example.com and so on the 17 words") for i in range(20)]
    rows += [(100, "write contact: root@localhost today"), (101, "see the root2@localhost today"), (102, "no data here")]
    docs = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, s int")
    spans = pii_bootstrap.find_spans(docs)
    new = spans.where("not base").select("doc_id", "kind", "s", "e").collect()
    same(new, [(100, "email", 15, 29)])
    clean = {r.doc_id: r.text for r in pii_bootstrap.redact(docs, spans).collect()}
    assert clean[100] == "write contact: <EMAIL> today" and clean[102] == "no data here"
    assert clean[3] == "some text then contact: <EMAIL> and so on the 17 words"


def test_pii_copies_and_recurring_values_keep_a_pattern(spark):
    rows = [(i, f"some text then contact: user{i}@mail.example.com and so on the 17 words") for i in range(20)]
    rows += [(i + 1000, t) for i, t in rows] + rows[:5]  # under other ids, and the same rows again
    rows += [(i, "in any case contact: help@mail.example.com for more") for i in range(2000, 2040)]
    rows += [(100, "write contact: root@localhost today"), (101, "see the root2@localhost today")]
    spans = pii_bootstrap.find_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    same(spans.where("not base").select("doc_id", "kind", "s", "e").collect(), [(100, "email", 15, 29)])


def test_pii_grouped_digits_and_word_after(spark):
    rows = [(i, f"please tel: +1 555 123 4{i:03d} and more") for i in range(20)]
    rows += [(50 + i, f"ask for user{i}@mail.example.com (mailbox) if needed") for i in range(20)]
    rows += [(100, "please tel: 555 123 4567, or not"), (101, "please tel: 555 123"), (102, "root@localhost (mailbox)"),
             (103, "see 555 123 4567 there"), (104, "please tel: 1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 1 2 3 4 5")]
    spans = pii_bootstrap.find_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    got = spans.where("not base and doc_id >= 100").select("doc_id", "kind", "s", "e").collect()
    # the value of 103 is the one that 100 has shown to be a phone number
    same(got, [(100, "phone", 12, 24), (102, "email", 0, 14), (103, "phone", 4, 16)])


def test_pii_word_before_anything_is_no_pattern(spark):
    rows = [(i, f"then contact: user{i % 20}@mail.example.com and contact: nobody or contact: us") for i in range(60)]
    rows += [(100, "write contact: root@localhost today")]
    assert pii_bootstrap.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).where("not base").count() == 0


# 5 ---------------------------------------------------------------------------------------------
def test_warc_store(spark):
    import hashlib
    big, small = "<p>" + "é" * 600 + "</p>", "tiny"
    rows = [(1, "http://a/1", big), (2, None, big), (3, "http://a/3\r\nX: y", big), (4, "u", small), (5, "u", small), (6, "u", None),
            (7, "u", ""), (8, "http://a/8", "z" * 200_000), (8, "http://a/8", "z" * 200_000), (None, "n", big), (None, "n", "w" * 2000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, address string")
    path = C.scratch(spark, "t")
    warc_store.write_archive(pages, path)
    top = {}
    for p, _, h in rows:
        if p is not None:
            top[h or ""] = max(top.get(h or "", p), p)
    exp = []
    for p, _, h in rows:
        raw, best = (h or "").encode(), top.get(h or "")
        again = len(raw) >= 1000 and best is not None and p != best
        exp.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", best if again else None))
    same(warc_store.read_index(spark, path).drop("url").collect(), exp)
    assert spark.read.parquet(path + "/payloads").count() == 5
    for r in warc_store.read_records(spark, path).where("page_id is not null").collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert len(rest) == int(fields["Content-Length"]) + 4 and rest.endswith(b"\r\n\r\n")
        http, _, payload = rest[:-4].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK")
        html = next(h for p, _, h in rows if p == r.page_id) or ""
        assert payload == (b"" if fields["WARC-Type"] == "revisit" else html.encode())


# 6 ---------------------------------------------------------------------------------------------
@pytest.mark.parametrize("flush", [1, 1 << 20])
def test_recompress(odd, odd_docs, flush):
    got = recompress.remove_repeats(odd_docs, flush_words=flush).collect()
    same([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], kept_words(odd))
    assert any(r.n_removed for r in got)


def test_recompress_random_repeats(spark):
    """Short vocabularies, so that runs, pairs and chance repeats of every length occur."""
    r = random.Random(11)
    rows = []
    for i in range(60):
        vocabulary = "ab" if i % 3 else "abcdefgh"
        rows.append((i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60)))))
    long = prose(12, 400)
    for i in range(60, 120):
        a, n = r.randint(0, 380), r.randint(5, 40)
        rows.append((i, " ".join(prose(100 + i, r.randint(0, 20)) + long[a:a + n] + prose(300 + i, r.randint(0, 20)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = recompress.remove_repeats(docs, flush_words=300).collect()
    same([(x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in got], kept_words(rows))


def test_every_window_holds_a_border():
    r = random.Random(2)
    from panelkit.llm import wordhash
    for vocabulary in ("a", "ab", "abcdefghijk"):
        h = wordhash.word_hashes([r.choice(vocabulary).encode() for _ in range(4000)])
        at, _, _ = recompress.borders(h, np.array([0, 4000]))
        for s in range(4000 - 13):
            i = np.searchsorted(at, s + 4)
            assert i < len(at) and at[i] <= s + 9


# 7 ---------------------------------------------------------------------------------------------
def test_langid(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = hd_langid.learn(docs.where("doc_id % 2 = 0"))
    got = hd_langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("doc_id % 2 = 1")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert right >= 0.97 * n
    odd = hd_langid.predict(odd_docs, model).collect()
    assert all(0 <= r.score <= 1 for r in odd) and all((r.lang_pred, r.score) == ("und", 0.0) for r in odd if r.doc_id in (1, 2, 3))
    assert next(r for r in odd if r.doc_id == 41).lang_pred != "und"
    assert {r.lang_pred for r in hd_langid.predict(odd_docs, hd_langid.learn(docs.where("false"))).collect()} == {"und"}


# 8 ---------------------------------------------------------------------------------------------
def test_cdc_bpe(odd, odd_docs):
    for bits in (4, 9):
        got = cdc_bpe.encode_documents(odd_docs, BYTE_BPE, bits=bits).collect()
        same([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got], [(d, *bpe(t)) for d, t in odd])
        assert all(len(r.ids) == 4 * r.n_tokens for r in got)


def test_cdc_bpe_reuses_chunks(spark):
    text = " ".join(prose(20, 3000))
    docs = spark.createDataFrame([(i, text[:-i] if i else text) for i in range(40)], "doc_id long, text string")
    n, new = cdc_bpe.encode_documents(docs, BYTE_BPE).agg(F.sum("chunks"), F.sum("encoded_chunks")).first()
    assert new < n / 3


def test_cdc_bpe_random_text():
    r = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "'s", "'", "é", "ß", "<|endoftext|>", "1", "23", "\t", "　", "\u0085", "!", "...", "the", "日本", "😀", "\r\n"]
    enc = cdc_bpe.ChunkEncoder(BYTE_BPE, 3, 1 << 14)
    for _ in range(1500):
        text = "".join(r.choice(parts) for _ in range(r.randrange(150)))
        ids = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert enc.encode(text.encode()) == np.array(ids, "<u4").tobytes()
        assert enc.decode(ids) == enc.tokenizer.decode(ids, skip_special_tokens=False)
        some = r.sample(ids, len(ids) // 2)  # in an order that breaks code points
        assert enc.decode(some) == enc.tokenizer.decode(some, skip_special_tokens=False)


def test_cdc_bpe_join_widens_until_the_tokenizer_agrees():
    """Cuts inside a word: the ids of the parts are not those of the whole, and the join grows until they are."""
    enc = cdc_bpe.ChunkEncoder(BYTE_BPE, 3, 1 << 14)
    text = b"the international conference today"
    safe = np.array([0, 4, 9, 12, 15, 21, 28, len(text)])
    a, b, ids = enc.join(text, safe, 3, 4, 0, len(safe) - 1)
    assert enc.widened and a < 3 and b > 4
    assert enc.library(text[:safe[a]]) + ids + enc.library(text[safe[b]:]) == enc.library(text)


def test_cdc_bpe_very_long_text_and_full_memo():
    text = " ".join(prose(21, 60_000)).encode()
    enc = cdc_bpe.ChunkEncoder(BYTE_BPE, 9, 1 << 16)
    assert enc.encode(text) == enc._library(text)
    assert enc.pieces.held <= (1 << 16) + 1000 and len(enc.pieces.old)


def test_word_memo(spark):
    from panelkit.llm.wordcache import Memo, WordIds
    calls = []
    memo = Memo(lambda k: calls.append(k) or k.upper(), 1000, longest=8)
    for i in range(200):
        assert memo[b"often"] == b"OFTEN" and memo[b"k%d" % i] == b"K%d" % i and memo[b"much too long"] == b"MUCH TOO LONG"
    assert calls.count(b"often") == 1 and calls.count(b"much too long") == 200 and memo.held < 1400
    enc, r = WordIds(WORD_BPE, 1 << 14), random.Random(3)
    for _ in range(3000):
        text = "".join(r.choice("abEÉéßÀÿ×÷µ'’.,!<|>12 \n\té\u0301İſK日😀-\xa0") for _ in range(r.randint(0, 30))).encode()
        assert enc.encode(text).tolist() == enc._library(text)


# 9 ---------------------------------------------------------------------------------------------
def test_pu_quality(spark, odd_docs):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    measured = pu_quality.measure(docs)
    model = pu_quality.fit(measured, labels, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    rows = pu_quality.score(measured, model).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.95 and 0.5 < model["prior"] < 0.95
    odd = pu_quality.score(pu_quality.measure(odd_docs), model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert pu_quality.fit(measured, labels.where("quality = 0"), F.lit(True)) is None
    assert {r.score for r in pu_quality.score(measured.limit(3), None).collect()} == {0.5}


def test_pu_prior():
    g = np.random.default_rng(4)
    p = g.normal(2, 1, (4000, 1))
    u = np.concatenate([g.normal(2, 1, (2800, 1)), g.normal(-2, 1, (1200, 1))])
    p, u = (np.hstack([x, np.ones((len(x), 1))]) for x in (p, u[g.permutation(len(u))]))
    assert abs(pu_quality.estimate_prior(p, u) - 0.7) < 0.06


# 10 --------------------------------------------------------------------------------------------
def test_winnow(spark, odd, odd_docs):
    passage = prose(2, 60)
    items = [(1, " ".join(passage[5:25])), (2, " ".join(passage[:12])), (10, "one two"), (3, None), (4, "..."), (5, " ".join(passage[20:33])),
             (5, " ".join(passage[20:33])), (None, "line of words"), (6, "the " * 14), (7, " ".join(prose(50, 40)))]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")
    got = winnow.decontaminate(odd_docs, bench).drop("tag").collect()
    same(got, [(d, *contamination(t, items)) for d, t in odd])
    clean = winnow.clean_rows(odd_docs, bench)
    assert clean.columns == odd_docs.columns
    same(clean.select("doc_id").collect(), [(r.doc_id,) for r in got if not (r.n_hit and 20 * r.n_hit >= r.n_words)])
    none = winnow.decontaminate(odd_docs, bench.where("false")).collect()
    assert all(r.n_hit == 0 for r in none)


# all -------------------------------------------------------------------------------------------
def test_empty_tables(spark, no_docs):
    path = C.scratch(spark, "t")
    bitplane.write_ids(no_docs, path, WORD_BPE)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    bench = spark.createDataFrame([], "item_id long, text string")
    measured = pu_quality.measure(no_docs)
    warc_store.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path + "w")
    for df in (bitplane.read_docs(spark, path), cascade.apply_rules(no_docs), cascade.kept_rows(no_docs),
               hyperminhash.near_duplicates(no_docs), pii_bootstrap.report(no_docs, pii_bootstrap.find_spans(no_docs)),
               warc_store.read_index(spark, path + "w"), recompress.remove_repeats(no_docs),
               hd_langid.predict(no_docs, hd_langid.learn(no_docs)), cdc_bpe.encode_documents(no_docs, BYTE_BPE),
               pu_quality.score(measured, pu_quality.fit(measured, labels, F.lit(True))), winnow.decontaminate(no_docs, bench)):
        assert df.count() == 0


def test_native_operators_use_no_python():
    import inspect
    for module in (pii_bootstrap, winnow, warc_store):
        source = inspect.getsource(module)
        assert not any(x in source for x in ("mapIn", "applyIn", "pandas", "udf", ".rdd"))
    assert words("a b") == ["a", "b"] and redacted("x a@b.cc") == "x <EMAIL>"


def _template(seed, size, differ, words=300):
    """Texts of one template, each with ``differ`` words of its own."""
    r = random.Random(seed)
    base = [f"w{seed}x{i}" for i in range(words)]
    out = []
    for i in range(size):
        text = list(base)
        for at in r.sample(range(words), differ):
            text[at] = f"own{i}y{at}"
        out.append(" ".join(text))
    return out


def _components(texts, width=4, percent=80):
    sets = [frozenset(zip(*[t.split()[i:] for i in range(width)], strict=False)) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("differ", [5, 10])
def test_near_duplicates_large_group(spark, differ):
    """500 texts of one template: about 0.86 similar (5 words differ), or 0.74 and mostly no link (10 words)."""
    texts = _template(differ, 500, differ)
    exp = _components(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = hyperminhash.near_duplicates(docs, width=4).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == list(enumerate(exp))
    assert len(set(exp)) == 1 if differ == 5 else len(set(exp)) > 400


def test_near_duplicates_repeated_rows(spark):
    text = _template(1, 2, 4)
    docs = spark.createDataFrame([(i % 2, text[i % 2]) for i in range(400)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in hyperminhash.near_duplicates(docs, width=4).collect()} == {(0, 0), (1, 0)}


def test_common_counts():
    r = np.random.default_rng(4)
    sets = [np.unique(np.concatenate([np.arange(20), r.integers(20, 400, r.integers(0, 60))])).astype(np.uint64) for _ in range(60)] + [np.zeros(0, np.uint64)]
    got = hyperminhash.common_counts(sets[:25], sets[25:])
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[25:]] for a in sets[:25]]


def test_one_of_each_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 7, 8), (2, "a b c d e f", 9, 9), (None, "x", 1, 1)], "doc_id long, text string, kept_id long, __d long")
    assert sorted(map(tuple, hyperminhash.one_of_each(docs).collect()), key=key) == [(1, "a b c d e f", 7, 8), (None, "x", 1, 1)]


def test_recompress_many_rows_without_id(spark):
    """Texts under one id, or none, are told apart whatever their number: the rows without a repeat lose nothing."""
    passage = " ".join(prose(2, 20))
    rows = [(1, passage)] + [(None, f"{passage} {i}" if i % 50 == 0 else " ".join(f"n{i}x{j}" for j in range(20))) for i in range(600)]
    rows += [(5, f"{passage} five" if i == 0 else " ".join(f"m{i}x{j}" for j in range(20))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = recompress.remove_repeats(docs).collect()
    same([(r.doc_id, r.n_words, r.n_removed) for r in got],
         [(d, len(t.split()), 20 if d != 1 and t.startswith(passage) else 0) for d, t in rows])


def test_pii_accepted_value_at_the_start(spark):
    rows = [(i, f"some text then contact: user{i}@mail.example.com and so on") for i in range(20)]
    rows += [(100, "write contact: root@localhost today"), (101, "root@localhost is mine"), (102, " " * 200 + "root@localhost")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = pii_bootstrap.find_spans(docs)
    assert sorted((r.doc_id, r.s, r.e) for r in spans.where("not base").collect()) == [(100, 15, 29), (101, 0, 14), (102, 200, 214)]


def test_clashing_names_stay(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cc now", 99, "t", 5)], "doc_id long, text string, __id long, span_runs string, bad_id int")
    items = spark.createDataFrame([("x", "nothing here")], "item_id string, text string")
    out = pii_bootstrap.redact(winnow.clean_rows(docs, items), pii_bootstrap.find_spans(docs))
    assert out.columns == docs.columns and tuple(out.first()) == (1, "mail <EMAIL> now", 99, "t", 5)


def test_pu_statistics_over_all_rows(spark):
    measured = pu_quality.measure(spark.createDataFrame([(i, " ".join(prose(i, 10 + i))) for i in range(60)], "doc_id long, text string")).repartition(4)
    x = pu_quality._inputs(np.array([r.x for r in measured.collect()]))
    mean, scale = pu_quality._moments(measured.select("x"))
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(scale, x.std(axis=0) + 1e-3)
    w, at = np.linspace(-1, 1, x.shape[1] + 1), np.array([-1.0, 0.0, 2.0])
    share, n = pu_quality._shares(measured.select("x"), mean, scale, w, at)
    assert n == 60 and np.allclose(share, [((pu_quality._scaled(x, mean, scale) @ w) >= a).mean() for a in at])
