"""The corpus pipeline: documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; ``run`` writes every stage's rows as Parquet into the shared folder and
reads them again for the next.  All but the last return the columns of
``documents``; the last returns one row per document of the token files, in
their order (``start`` counts the ids of all documents before it).

No stage moves or copies texts but the last, which deals them by id: near-dedup,
decontamination and mix tell rows apart by their place in the files of the stage
before and join a bit for each row.  Documents that the quality rules keep go on
whole: their failing lines count against them, but later stages compare, and the
token files hold, the texts as they came.

An empty table passes through as one.  Repeated ids and extra columns are
handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripforge.llm import decontaminate, mixing, quality, simhash, tokens
from tripforge.llm.common import read, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules keep."""
    return quality.keep_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with a benchmark text."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's share asks for."""
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """rANS token files, and what is read back from them."""
    index, folder = tokens.write_token_files(docs)
    return tokens.read_token_files(spark, index, folder)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate_benchmark),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]

# Fingerprints and a tokenizer are beyond SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
