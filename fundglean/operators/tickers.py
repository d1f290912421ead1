"""Ticker symbols -> company numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN_CIK = "XXXX"  # fixed value for a ticker without a known company
SHORT_TICKER = 3  # unknown tickers of this length or less are dropped


def symbol_key(symbol: Column) -> Column:
    return F.upper(F.trim(symbol))


def lookup_tickers(mapping: DataFrame, tickers: DataFrame) -> DataFrame:
    """``(ticker, cik)`` for every distinct ticker.

    ``mapping`` has symbol, cik and ordinal; of repeated symbols the last one
    holds. Both sides are reduced to one row per key before they meet.
    """
    known = mapping.groupBy(symbol_key(F.col("symbol")).alias("ticker")).agg(
        F.max_by("cik", "ordinal").alias("known_cik")
    )
    asked = tickers.select(symbol_key(F.col("ticker")).alias("ticker")).distinct()
    cik = F.coalesce(
        "known_cik", F.when(F.length("ticker") > SHORT_TICKER, F.lit(UNKNOWN_CIK))
    )
    return (
        asked.join(known, "ticker", "left")
        .select("ticker", cik.alias("cik"))
        .where(F.col("cik").isNotNull())
    )
