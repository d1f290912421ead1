"""Row filters and lookups on the index and chunk tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundglean.operators.skew import salted_join
from fundglean.schemas import FILING_KEYS


def with_tag(df: DataFrame, tag: str) -> DataFrame:
    """Rows whose tag array holds ``tag``; NULL tags never match."""
    return df.where(F.array_contains("tags", tag))


def without_exact_tag(df: DataFrame, tag: str) -> DataFrame:
    """Rows left after deleting those whose tag array is exactly ``[tag]``."""
    return df.where(~F.col("tags").eqNullSafe(F.array(F.lit(tag))))


def assign_tag(df: DataFrame, tag: str) -> DataFrame:
    return df.withColumn("tags", F.array(F.lit(tag)))


def of_form_type(df: DataFrame, form_type: str = "") -> DataFrame:
    """Case-insensitive form type; an empty filter keeps all rows that have one."""
    df = df.where(F.col("form_type") != "")
    if form_type:
        df = df.where(F.upper("form_type") == form_type.upper())
    return df


def filed_between(df: DataFrame, first: str, last: str) -> DataFrame:
    """Closed range of filing dates."""
    return df.where(
        F.col("date_filed").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )


def chunks_of(
    chunks: DataFrame, cik: str, accession_number: str, chunk_nums: Sequence[int] = ()
) -> DataFrame:
    """Chunks of one filing in order; no chunk numbers means all of them."""
    found = chunks.where(
        (F.col("cik") == cik) & (F.col("accession_number") == accession_number)
    )
    if chunk_nums:
        found = found.where(F.col("chunk_num").isin(list(chunk_nums)))
    return found.orderBy("chunk_num")


def filings_of_tag(index: DataFrame, tag: str, limit: int = 0) -> DataFrame:
    """Distinct filing keys of a tag; ``limit`` 0 means all, else the first by key."""
    keys = with_tag(index, tag).select(*FILING_KEYS).distinct()
    return keys.orderBy(*FILING_KEYS).limit(limit) if limit else keys


def not_yet_in(filings: DataFrame, done: DataFrame | None) -> DataFrame:
    """Filings without any row in ``done``; no table yet means none is done."""
    if done is None:
        return filings
    return filings.join(done.select(*FILING_KEYS).distinct(), list(FILING_KEYS), "left_anti")


def document_of_type(manifest: DataFrame, doc_type: str, keys=FILING_KEYS) -> DataFrame:
    """Per filing the file of a type: status ``ok``, ``missing`` or ``ambiguous``."""
    wanted = F.col("type") == doc_type
    counted = manifest.groupBy(*keys).agg(
        F.count_if(wanted).alias("n"), F.max(F.when(wanted, F.col("filename"))).alias("f")
    )
    return counted.select(
        *keys,
        F.when(F.col("n") == 1, F.col("f")).alias("filename"),
        F.when(F.col("n") == 1, "ok")
        .when(F.col("n") == 0, "missing")
        .otherwise("ambiguous")
        .alias("status"),
    )


def requested_chunks(chunks: DataFrame, requests: DataFrame) -> DataFrame:
    """Chunk lookup for many filings at once.

    ``requests`` has the filing keys and ``chunk_nums``; an empty array asks for
    all chunks of the filing.
    """
    wanted = (F.size("chunk_nums") == 0) | F.array_contains(
        F.col("chunk_nums"), F.col("chunk_num")
    )
    return (
        salted_join(
            chunks, requests.select(*FILING_KEYS, "chunk_nums"), FILING_KEYS, "inner"
        )
        .where(wanted)
        .select(*chunks.columns)
    )
