"""A training corpus from raw documents: filter, deduplicate twice, mix, pack.

Every stage takes all rows its predecessor kept. Nulls, empty texts, repeated rows and empty tables
have the results that the operators state. The last stage returns pieces of sequences, the others
the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import exact_dedup, minhash, mixing, packing, toxicity
from tideline.llm.common import stage, table
from tideline.llm.queries import packing_vocabulary

# Order, ranks and cuts of a mix and a packing have no SQL form; tests hold them to brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5. The model learns from labelled rows of these documents."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_toxicity(docs, model, "toxicity score")
    return scored.filter(F.col("toxicity score") < 0.5).select(*(f"`{c}`" for c in docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per distinct text."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as their source's target takes them."""
    return mixing.mixed(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows."""
    return packing.pack(docs, packing_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
