"""The documents table made into training tokens, stage by stage.

Each stage gets what the one before wrote, and works on all of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import decontaminate, mixing, simhash, token_files, toxicity
from tributary.llm.queries import WORD_BPE_VOCABULARY, chosen_documents, table, word_bpe
from tributary.llm.storage import stored
from tributary.session import scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at two bits or fewer."""
    return simhash.keep_one(docs, shingle=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), span=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The target mix; a document that two epochs take is there twice."""
    return mixing.mix(docs, chosen_documents(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and per document what they hold of it."""
    path = scratch_dir(spark, "corpus-tokens")
    token_files.write_tokens(docs, path, word_bpe(), WORD_BPE_VOCABULARY)
    return token_files.read_tokens(spark, path, WORD_BPE_VOCABULARY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


# Learned scores and tokenizers are beyond SQL; tests/llm holds it against plain Python.
ORACLE_SQL = None
