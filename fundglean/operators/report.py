"""Export join and summary statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundglean.operators.filters import with_tag
from fundglean.schemas import FILING_KEYS


def export_rows(
    index: DataFrame,
    results: DataFrame,
    index_tag: str,
    result_tag: str,
    limit: int | None = None,
) -> DataFrame:
    """Distinct tagged filings with their tagged results, NULLs where there is none.

    Both sides are made distinct before the join, so repeated loads of a filing
    never multiply with repeated results; the joined rows are then distinct too.
    Each side is dealt out by filing once; copies of a row meet in that exchange,
    and the join needs no other.
    """
    keys = [F.col(k) for k in FILING_KEYS]
    filings = (
        with_tag(index, index_tag)
        .repartition(*keys)
        .select(
            *FILING_KEYS,
            "company_name",
            "form_type",
            F.date_format("date_filed", "yyyy-MM-dd").alias("date_filed"),
            F.col("idx_filename").alias("filename"),
        )
        .distinct()
    )
    found = (
        with_tag(results, result_tag)
        .repartition(*keys)
        .select(
            *FILING_KEYS,
            F.col("selected_chunks").alias("chunks_used"),
            F.col("selected_text").alias("relevant_text"),
            F.col("n_trustee").alias("num_trustees"),
            F.col("response").alias("trustees_comp"),
        )
        .distinct()
    )
    joined = filings.join(found, list(FILING_KEYS), "left")
    return joined if limit is None else joined.orderBy(*joined.columns).limit(limit)


def table_stats(rows: DataFrame) -> DataFrame:
    """Distinct companies, distinct filings and rows of a chunk or vector table.

    Rows are first counted per filing, so the distinct counts see one row for
    each filing instead of one for each chunk.
    """
    per_filing = rows.groupBy(*FILING_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return per_filing.agg(
        F.count_distinct("cik").alias("cik"),
        F.count_distinct("accession_number").alias("filings"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )


def outcome_by_filing(results: DataFrame, tag: str) -> DataFrame:
    return with_tag(results, tag).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("n_trustee") > 1).alias("accepted"),
        F.count_if(F.col("n_trustee") <= 1).alias("not_accepted"),
    )


def outcome_by_company(results: DataFrame, tag: str) -> DataFrame:
    by_company = (
        with_tag(results, tag)
        .groupBy("cik")
        .agg(
            F.count(F.lit(1)).alias("n_filings"),
            F.count_if(F.col("n_trustee") >= 1).alias("extracted"),
        )
    )
    return by_company.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("extracted") > 0).alias("extracted"),
        F.count_if(F.col("extracted") == 0).alias("failed"),
    )
