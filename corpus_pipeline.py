"""From raw documents to token ids: quality rules, near-duplicates, benchmark
contamination, personal data, BPE ids.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and
returns the columns of ``documents``, but for the last, which returns the ids of each text.
An empty stage gives an empty one; nulls, ties and repeated rows are as the operators define them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import cascade, cdc_bpe, hyperminhash, pii_bootstrap, winnow
from panelkit.llm import common as C

ORACLE_SQL = None  # sketches, bootstrapping and BPE are beyond SQL; tests/llm compares with plain Python


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return cascade.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents (five-word shingles, similarity of 0.8 or more) the one with the smallest doc_id stays."""
    return hyperminhash.one_of_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go."""
    return winnow.clean_rows(docs, C.table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind; n_chars follows."""
    out = pii_bootstrap.redact(docs, pii_bootstrap.find_spans(docs))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit), ids_sha256, decoded_sha256."""
    out = cdc_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("personal_data", personal_data), ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = C.saved(stage(spark, docs, sf_dir), name)
    return docs
