"""Documents from raw to training mix, in stages that call operators of fundglean.llm.

Every stage takes what the one before it kept, and all but the last return the
columns of the documents, under the names and with the values they came with, whatever
they are called. Documents are told apart by rows, not by ids: rows with a null id stay
documents of their own. An empty table stays empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundglean.llm import decontaminate, line_dedup, mixing, simhash
from fundglean.llm import quality_rules as rules
from fundglean.llm.common import checkpoint, fresh, table

#: SQL cannot express the trained line field nor the closure of fingerprint links.
ORACLE_SQL: str | None = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rules or the line field reject.

    Null and empty texts go, for want of words; equal texts are judged alike.
    """
    field = rules.fit(rules.sample(docs, table(spark, sf_dir, "labels")))
    name = fresh(docs, "verdict")
    kept = rules.verdicts(docs, field, name=name)
    return kept.where(f"{name}.kept").drop(name)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later copies of runs of lines with 50 words or more out of the texts.

    ``n_chars`` counts the characters of what is left. No document goes: one all of whose lines
    go keeps an empty text, a null text stays null. Rows with the same id and text are one
    document, and are cut alike; of equal runs the one of the smallest id stays, null first.
    """
    own = {c: fresh(docs, f"own_{c}") for c in docs.columns if c.lower() == "n_deleted"}
    cut = line_dedup.dedup_lines(docs.withColumnsRenamed(own))
    if "n_chars" in docs.columns:
        length = F.length("text").cast("long")
        cut = cut.withColumn("n_chars", F.when(F.col("n_deleted") > 0, length).otherwise(F.col("n_chars")))
    return cut.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group: three-word shingles, three bits.

    That of the smallest id; of rows with one id, or without any, one. Texts without words
    have one fingerprint and are a group.
    """
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap with a benchmark item.

    Null and empty texts stay; equal rows go or stay together.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that all sources weigh the same, in shuffled order.

    A null source is a source; equal rows are repeated alike. Columns ``copy`` and
    ``shuffle_key`` are added, in place of columns of these names.
    """
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_near),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each one kept is written before the next, which reads it repeatedly."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = checkpoint(docs)
    return docs
