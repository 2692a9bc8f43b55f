"""Documents to training pieces: toxic ones out, one of each near-copy group, no secrets, mixed sources, pieces.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next one's documents. Rows keep the columns of ``documents`` up to the last
stage. Nulls, empty texts, repeated rows and empty tables go through every stage by the
rules in its operator's module.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from plaudit.llm import minhash, mixing, pieces, secrets, toxicity
from plaudit.llm.common import table, written


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier scores below 0.5."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return minhash.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to their kind in brackets, and lengths follow; every document stays."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.mix(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, begins, ends): the pieces of every text and their byte spans in it."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", not_toxic),
    ("near_copies", distinct_texts),
    ("secrets", without_secrets),
    ("mix", source_mix),
    ("pieces", to_pieces),
]

#: SQL can express neither the learned nor the Python stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
