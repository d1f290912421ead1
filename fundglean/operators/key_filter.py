"""A filter of filings that are done, which lets most new ones pass without a join.

Each filing sets a few of a fixed number of bits, told by hashes of its keys. A filing one
of whose bits is not set is not done for sure; all others are held against the table of
what is done. Filters of several loads are merged by their bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundglean.operators.filters import not_yet_in
from fundglean.schemas import FILING_KEYS

LG_BITS = 24  # 2 MB
HASHES = 4


def places(lg_bits: int = LG_BITS, hashes: int = HASHES) -> list[Column]:
    """The bits of a filing."""
    keys = [F.col(k) for k in FILING_KEYS]
    return [F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(1 << lg_bits)) for i in range(hashes)]


def filter_words(done: DataFrame, *by: str, lg_bits: int = LG_BITS) -> DataFrame:
    """``word`` and ``bits``: the words of the filter that have bits set, for each of ``by``."""
    set_bits = done.select(*by, F.explode(F.array(*places(lg_bits))).alias("place"))
    bit = F.expr("shiftleft(1L, cast(pmod(place, 64) AS int))")
    return set_bits.groupBy(*by, F.shiftright("place", 6).cast("int").alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )


def merged(words: DataFrame, lg_bits: int = LG_BITS) -> DataFrame:
    """The whole filter as one row with an array of ``1 << (lg_bits - 6)`` words."""
    every = words.sparkSession.range(1 << (lg_bits - 6)).select(
        F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits")
    )
    all_words = words.select("word", "bits").unionAll(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return all_words.agg(ordered.alias("words")).select(F.col("words.bits").alias("words"))


def may_be_done(words: DataFrame, lg_bits: int = LG_BITS) -> Column:
    """Whether all bits of a filing are set in the merged filter."""
    filter_ = words.scalar()
    tests = [
        F.getbit(F.get(filter_, F.shiftright(place, 6).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1
        for place in places(lg_bits)
    ]
    return reduce(Column.__and__, tests)


def not_done(
    filings: DataFrame, done: DataFrame, words: DataFrame, lg_bits: int = LG_BITS
) -> DataFrame:
    """As :func:`fundglean.operators.filters.not_yet_in`, by way of the filter of ``done``.

    Only filings that may be done meet the table.
    """
    marked = filings.withColumn("_met", may_be_done(words, lg_bits))
    new = marked.where(~F.col("_met")).drop("_met")
    met = marked.where("_met").drop("_met")
    return new.unionByName(not_yet_in(met, done).select(*filings.columns))
