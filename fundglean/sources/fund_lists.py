"""Ticker files: column-oriented JSON, plain CSV lists, and the map written out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def columnar_rows(files: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of ``{"fields": [...], "data": [[...], ...]}`` texts in column ``value``."""
    parsed = files.select(
        F.from_json("value", "fields array<string>, data array<array<string>>").alias("j")
    )
    rows = parsed.select("j.fields", F.posexplode("j.data").alias("ordinal", "row"))
    return rows.select(
        "ordinal",
        *[
            F.get("row", (F.array_position("fields", name) - 1).cast("int")).alias(name)
            for name in names
        ],
    )


def read_columnar_json(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    return columnar_rows(spark.read.text(path, wholetext=True), names)


def read_fund_list(spark: SparkSession, path: str) -> DataFrame:
    """First field of every line, as ``ticker``."""
    return spark.read.text(path).select(
        F.element_at(F.split("value", ","), 1).alias("ticker")
    )


def write_ticker_map(tickers: DataFrame, path: str) -> None:
    tickers.select("ticker", "cik").write.csv(path, header=False)
