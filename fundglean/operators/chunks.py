"""Chunk tables: numbering, and dropping filings with a single chunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundglean.operators.skew import salted_join
from fundglean.schemas import FILING_KEYS


def numbered(df: DataFrame, items: Column, name: str, keys=FILING_KEYS) -> DataFrame:
    """One row per array element, numbered from 0."""
    return df.select(*keys, F.posexplode(items).alias("chunk_num", name))


def of_filings(rows: DataFrame, filings: DataFrame) -> DataFrame:
    """Rows of the given filings."""
    kept = salted_join(rows, filings.select(*FILING_KEYS), FILING_KEYS, "left_semi")
    return kept.select(*rows.columns)


def several_chunks(chunks: DataFrame) -> DataFrame:
    """Rows of filings that have more than one row.

    Counts are combined before the shuffle and only the counts of filings meet
    the rows again, in a salted semi join.
    """
    many = (
        chunks.groupBy(*FILING_KEYS)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select(*FILING_KEYS)
    )
    return of_filings(chunks, many)
