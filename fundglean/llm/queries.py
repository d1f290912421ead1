"""One query per operator over the given tables, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundglean.llm import (
    chat_format,
    decontaminate,
    importance_resampling,
    language_id,
    line_dedup,
    lm_scoring,
    merkle_manifest,
    mixing,
    personal_data,
    quality_rules,
    simhash,
    token_alignment,
    token_files,
)
from fundglean.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sampled = quality_rules.sample(docs, table(spark, folder, "labels"))
    return quality_rules.quality_rules(docs, quality_rules.fit(sampled))


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.learn_and_predict(table(spark, folder, "documents"))


@query
def op4_importance_sample(spark: SparkSession, folder: str) -> DataFrame:
    target, share = importance_resampling.labelled_target(table(spark, folder, "labels"))
    docs = table(spark, folder, "documents")
    return importance_resampling.importance_sample(docs, target, share)


@query
def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op8_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, folder, "documents"))


@query
def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(extra)))


@query
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


ORACLES["op2_mix_sources"] = mixing.sql()


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, folder, "documents"))


ORACLES["op5_line_dedup"] = line_dedup.sql()


@query
def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.personal_data(table(spark, folder, "documents"))


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, folder, "documents"))


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tree = merkle_manifest.manifest(docs, merkle_manifest.without_newlines())
    return merkle_manifest.proofs(tree)


ORACLES["op13_merkle_manifest"] = merkle_manifest.sql()


@query
def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    found = token_files.round_trip(table(spark, folder, "documents"))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
