"""From raw documents to packed training sequences, in stages that each apply one operator.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written
as Parquet and read again as the next one's ``docs``. All but the last keep the
columns of ``documents``. Document ids are taken to be unique.

An empty table passes through all stages; null texts are clean, unlike any
other text, without secrets, of size 0 and so not in the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hindsight.llm import mixing, order_minhash, packing, secrets, toxicity
from hindsight.llm.work import prepare, stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return order_minhash.keep_one(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them replaced by a mark."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs, [3, 1, 2], 1.5)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", hide_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained classifier and a tokenizer decide: SQL can't say it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the table ``documents``."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
