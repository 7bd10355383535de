"""A corpus from raw documents: good ones, one of each group of near copies, no benchmark items, no secrets, as ids.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and
read again as the next stage's documents.  All but the last return the columns
of ``documents``.  An empty table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scanledger.llm import bpe, credentials, decontamination, jaccard, quality
from scanledger.llm.common import staged, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of copies and near copies."""
    return jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontamination.drop_holders(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return credentials.redact(docs)


def as_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and digests of each document: encoded, and decoded again."""
    coded = bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_decoded=False)
    return coded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", good_documents),
    ("near_copies", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", as_ids),
]

#: Robust estimates and byte-pair merges have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
