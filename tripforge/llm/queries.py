"""The operators of this subpackage as registered queries: (spark, sf_dir) -> DataFrame.

Each runs its operator with its production parameters over the whole table and
derives the digest columns from the operator's rows."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.llm import (
    decontaminate,
    extract,
    licenses,
    mixing,
    negatives,
    quality,
    secrets,
    simhash,
    substrings,
    tokens,
    toxicity,
    warc,
    whitening,
)
from tripforge.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(read(spark, sf, "documents"))


def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf, "documents"))


def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    index = warc.write_bundles(read(spark, sf, "pages"))
    return warc.read_bundles(spark, index)


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash.simhash_groups(read(spark, sf, "documents"), shingle=3, radius=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.overlaps(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op6_mix(spark: SparkSession, sf: str) -> DataFrame:
    plan = mixing.mix_plan(read(spark, sf, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op7_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_finds(read(spark, sf, "documents"))


def op8_tokens(spark: SparkSession, sf: str) -> DataFrame:
    index, folder = tokens.write_token_files(read(spark, sf, "documents"))
    return tokens.read_token_files(spark, index, folder)


def op9_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract.main_texts(read(spark, sf, "pages"))


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return quality.quality_signals(docs).select("doc_id", *quality.SIGNALS, "base_failed", "kept")


def op11_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op12_whiten(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(read(spark, sf, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return negatives.mine(read(spark, sf, "embeddings"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_secrets, op2_substring_dedup, op3_warc, op4_simhash, op5_decontaminate, op6_mix, op7_licenses,
        op8_tokens, op9_main_text, op10_quality, op11_toxicity, op12_whiten,
        op13_hard_negatives, pipeline)}
