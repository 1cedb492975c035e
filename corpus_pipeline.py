"""A corpus pipeline: quality rules, near-duplicates, personal data, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; its
result is written and read again as the next one's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.llm import bpe, mixing, pii, quality_rules, simhash
from stocklens.llm.common import settle, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level rules keep."""
    return quality_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data and disclosing terms replaced; n_chars follows."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate in the target mix says."""
    return mixing.resample(docs, table(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and digests of them and of the decoded text."""
    return bpe.encode(
        docs, public_tokenizers.path("word_bpe_49k.json"), keep=("doc_id", "lang", "source")
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: Fingerprints, trained weights and tokens have no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
