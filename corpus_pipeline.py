"""The corpus pipeline: five operators in a row, each stage written and read again.

language ID -> quality rules -> n-gram Jaccard join -> secret scans -> packing.
The first three drop documents, the fourth masks secrets, the last packs token ids.

Defined cases. Null and blank texts, and texts without a letter, have no language and go in the
first stage, as do all documents where none has a language label. Texts under 50 words go in
the second. Of repeated rows, and of near copies, the third keeps the row of the least id (null
ids last), of equal ids that of the least text key. Very long texts are processed whole. An empty
table stays empty. Further columns, of whatever names, are carried along to the last stage,
which returns pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.llm import jaccard_join, langid, packing, quality, secret_scan
from kinloom.session import read_table, staged


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages, not much less sure than a guess among four."""
    return langid.filter_documents(docs, langid.train(docs), least=0.4)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and stand near a language's references."""
    return quality.filter_documents(docs, quality.fit_references(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near duplicates."""
    return jaccard_join.distinct_documents(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in the text masked and n_chars counted again."""
    masked = secret_scan.masked_documents(docs)
    if "n_chars" not in docs.columns:
        return masked
    counted = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return masked.withColumn("n_chars", counted)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("jaccard_join", one_of_each_group),
    ("secret_scan", without_secrets),
    ("packing", packed),
]
#: A trained network and a tokenizer are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
