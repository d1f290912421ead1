"""Joins of a large table with a lookup, safe for keys that hold much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str, salts: int = SALTS
) -> DataFrame:
    """``rows.join(lookup, keys, how)`` with the rows of a key spread over tasks.

    Rows take a salt from their input partition, so equal copies spread as well;
    the lookup, one row or few for a key, is repeated for every salt. The result
    is not partitioned by ``keys``, hence a later step by ``keys`` shuffles what
    is left of its input after its own map-side reduction, and adaptive execution
    stays free to split a skewed partition of this join further.
    """
    salted = rows.withColumn(
        "_salt", F.pmod(F.spark_partition_id(), F.lit(salts)).cast("int")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    return salted.join(lookup.select("*", every), [*keys, "_salt"], how).drop("_salt")
