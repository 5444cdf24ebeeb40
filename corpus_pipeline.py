"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays, sources are mixed, the rest is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbflow.llm import common, mixing, ngram_join, packing, queries, toxicity

#: Documents of this score or more are rejected.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below TOXIC, with their columns; learned from labels that aren't held out."""
    scored = toxicity.score(docs, common.table(spark, sf_dir, "labels"))
    return scored.where(f"score < {TOXIC}").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): that of the smallest doc_id."""
    return ngram_join.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the words that the mix of sources takes from them; those of which it takes none go."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.best_fit(docs, queries.TOKENIZER)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("mixing", mix_sources), ("packing", pack)]

#: The stages' models, graphs and packing aren't SQL; the tests look at each stage's columns and rows, and hold its operator against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each stored for the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
