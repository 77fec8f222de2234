"""From raw documents to packed training sequences.

STAGES are applied in order, each to all that the one before it kept; every
result is written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import minhash, mixing, packing, toxicity
from tessera.llm.common import stored
from tessera.llm.queries import table, tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents predicted toxic go."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each near-duplicate group stays."""
    return minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: each document as often as the mix takes it, 0 to 2 times."""
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"), capacity=2048)


STAGES = [("toxicity", drop_toxic), ("near-duplicates", drop_near_copies), ("mixing", mix_sources), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: Models, signatures and flows cannot be said in SQL; tests/llm checks the stages.
ORACLE_SQL = None
