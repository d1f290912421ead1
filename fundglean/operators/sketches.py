"""Distinct counts by sketches that are kept for each load and merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_SIZE = 16  # 64 KB a sketch, with a standard error of 0.3 %


def sketched(rows: DataFrame, *by: str) -> DataFrame:
    """``rows``, ``ciks`` and ``filings`` of a table's rows, sketches of distinct values."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.hll_sketch_agg("cik", LG_SIZE).alias("ciks"),
        F.hll_sketch_agg("accession_number", LG_SIZE).alias("filings"),
    )


def merged(sketches: DataFrame) -> DataFrame:
    """About what ``report.table_stats`` counts, and exactly how many rows there are."""

    def estimate(name: str) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0))

    return sketches.agg(
        estimate("ciks").alias("cik"),
        estimate("filings").alias("filings"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
    )
