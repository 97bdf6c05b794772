"""From documents to training sequences: toxic documents go, one of each group of near copies stays, sources are
mixed to their target weights, and what is left is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from changelens.llm import minhash, mixing, packing, toxicity
from changelens.llm.shared import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.3. The model learns from the labels beside the documents, but
    never from the rows held out; only texts are scored. Null texts score as empty ones."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), 0.3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by a similarity of 0.8 on five-word shingles. Documents without words stay."""
    return minhash.deduplicated(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget takes them; the one at the cut with its first words alone."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each with its sequence of at most 1024 tokens and its place there."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the learned scores nor the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
