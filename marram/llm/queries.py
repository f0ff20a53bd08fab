"""The operators bound to the shared tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marram.llm import (
    align, chat, cleaning, decontaminate, language, licenses, mixing, quality, resample, sharding, simhash, suffixes, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(_table(spark, sf_dir, "documents")).drop("class_root")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.quality_report(_table(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeat_report(_table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], told.schema)
    return chat.chat_report(told.union(own))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(_table(spark, sf_dir, "documents"))


def op12_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment_report(_table(spark, sf_dir, "documents"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.importance_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_simhash": op2_simhash,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality": op4_quality,
    "op5_shards": op5_shards,
    "op6_quality_rules": op6_quality_rules,
    "op7_repeats": op7_repeats,
    "op8_language": op8_language,
    "op9_toxicity": op9_toxicity,
    "op10_chat": op10_chat,
    "op11_licenses": op11_licenses,
    "op12_align_tokens": op12_align_tokens,
    "op13_resample": op13_resample,
}

ORACLES: dict[str, str] = {
    "op1_mix_sources": mixing.MIX_SQL,
    "op6_quality_rules": cleaning.quality_sql(),
    "op10_chat": chat.CHAT_SQL,
    "op11_licenses": licenses.license_sql(),
    "op13_resample": resample.RESAMPLE_SQL,
}
