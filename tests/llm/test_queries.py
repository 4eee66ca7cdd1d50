"""The registered queries against their SQL twins, and the pipeline against plain Python."""

import os
import sys

import pytest
from brute import bpe, contamination, near_duplicates, redacted, rule_rejects
from llm_fixtures import odd, odd_docs  # noqa: F401

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import corpus_pipeline  # noqa: E402
from oracle_check import compare, duck_connect  # noqa: E402

from panelkit.llm import common as C  # noqa: E402
from panelkit.llm.queries import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    r = compare(spark, duck_connect(SF), name, QUERIES[name], SQL[name], SF)
    assert r["ok"], r


def test_all_numbers_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = [(r.doc_id, r.text) for r in C.table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in C.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    left = [r for r in docs if not rule_rejects(r[1])]
    roots = near_duplicates(left, 5)
    left = [r for r in left if roots[r[0]] == r[0]]
    bad = {d: contamination(t, items) for d, t in left}
    left = [(d, t) for d, t in left if not (bad[d][1] and 20 * bad[d][1] >= bad[d][0])]
    exp = sorted((d, *bpe(redacted(t))) for d, t in left)
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == exp
    assert 0 < len(exp) < len(docs)


def test_pipeline_stages(spark, odd, odd_docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "token_ids"]
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = C.saved(stage(spark, docs, SF), name)
        assert docs.columns == odd_docs.columns
    assert 0 < docs.count() < len(odd)
    empty = odd_docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
