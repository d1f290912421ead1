"""Seeded random sample of companies, exact in size and without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundglean.operators.filters import assign_tag, filed_between

BUCKET_DIGITS = 3  # hex digits: 4,096 buckets of the hash order


def sample_ciks(
    index: DataFrame, funds: DataFrame, first: str, last: str, seed: str = "", divisor: int = 10
) -> DataFrame:
    """``ceil(n / divisor)`` of the ``n`` fund companies that filed in a date range.

    The order is md5 of cik and seed, so a rerun draws the same companies. The
    rank is made of a rank within one hash bucket and the number of companies in
    earlier buckets; only the bucket counts (at most 4,096 rows) are broadcast or
    seen by a single task.
    """
    companies = (
        filed_between(index, first, last)
        .select("cik")
        .distinct()
        .join(funds.select("cik").distinct(), "cik", "left_semi")
        .select("cik", F.md5(F.concat("cik", F.lit(seed))).alias("draw"))
        .withColumn("bucket", F.substring("draw", 1, BUCKET_DIGITS))
    )
    everything = Window.partitionBy()
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.ceil(F.sum("n").over(everything) / divisor)
    buckets = (
        companies.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("quota", quota)
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .where(F.col("before") < F.col("quota"))
        .select("bucket", "before", "quota")
    )
    in_bucket = Window.partitionBy("bucket").orderBy("draw", "cik")
    return (
        companies.join(F.broadcast(buckets), "bucket")
        .withColumn("rank", F.col("before") + F.row_number().over(in_bucket))
        .where(F.col("rank") <= F.col("quota"))
        .select("cik")
    )


def sample_index(
    index: DataFrame, sampled: DataFrame, first: str, last: str, tag: str
) -> DataFrame:
    """Distinct index rows of the sampled companies in a date range, tagged."""
    rows = (
        filed_between(index, first, last)
        .join(sampled.select("cik").distinct(), "cik", "left_semi")
        .select(*index.columns)
        .distinct()
    )
    return assign_tag(rows, tag)
