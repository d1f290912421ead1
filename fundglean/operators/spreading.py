"""Use of all cores where a CPU-bound step reads few input splits."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str, waves: int = 1) -> DataFrame:
    """Rebalance by key if the input has fewer partitions than there are task slots.

    An input of ordinary size has far more splits than slots and is left as it
    is: the text steps then need no shuffle at all. With ``waves``, so many splits a slot
    are asked for: a few more splits than slots leave most slots idle in the last wave, which
    matters where rows are short and much is done with each.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots * waves:
        return df.repartition(slots * waves, *keys)
    return df
