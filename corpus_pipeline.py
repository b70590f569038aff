"""A training corpus from raw documents: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, mixing, similar, token_store, toxicity
from ledgerloom.llm.common import load, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: rows that the toxicity classifier rejects go. Null and empty texts stay; an empty table stays empty."""
    labels = toxicity.training_labels(load(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: one row of each group of near-duplicates stays, the smallest id. Texts without words are one group."""
    return similar.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: rows that hold a benchmark window go. Null and empty texts stay."""
    return decontaminate.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: the rows that the mixture takes, each once. Null languages and sources are leaves of their own."""
    return mixing.mixed(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: a token store, and what it holds of every row. A null text is empty; a null id comes first."""
    return token_store.token_store(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: SQL can neither train nor run the classifier and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole `documents`. Each keeps every column but the last; an empty table gives no rows."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
