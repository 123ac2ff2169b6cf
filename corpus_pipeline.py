"""The training-data pipeline: toxicity, exact dedup, near dedup, secret scans, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it
kept.  What a stage returns is written and read again, so a lost executor costs at most
the work of one stage.  All but the last keep the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docketry.llm import exact_dedup, near_dedup, packing, secrets, toxicity
from docketry.llm.common import stage, table

TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go; null and empty texts stay."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space one stays; null and empty texts are one group."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles, similarity 0.8 or more, the smallest id stays."""
    return near_dedup.drop_near_duplicates(docs, near_dedup.Rule(words=5, percent=80))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are masked and ``n_chars`` follows."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences with their ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER)).drop("row")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", hide_secrets),
    ("packing", pack),
]

#: SQL can express neither the fitted models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
