import pytest
from pyspark.sql import functions as F

from fundglean.operators.chunks import several_chunks
from fundglean.operators.skew import salted_join
from fundglean.operators.spreading import spread


def counts(df):
    return {tuple(r)[:-1]: r["count"] for r in df.groupBy(*df.columns).count().collect()}


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_salted_join_is_the_plain_join(spark, how, broadcast):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)
    rows = spark.range(600, numPartitions=6).select(key.alias("k"), (F.col("id") % 7).alias("v"))
    lookup = spark.range(0, 60, 5).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    try:
        got = counts(salted_join(rows, lookup, ["k"], how))
        assert got == counts(rows.join(lookup, ["k"], how))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_filings_with_one_chunk_are_dropped(spark):
    rows = [("1", "a", 0), ("2", "a", 0), ("2", "a", 1), ("1", "b", 5), ("1", "b", 5)]
    chunks = spark.createDataFrame(rows, "cik string, accession_number string, chunk_num int")
    got = sorted(tuple(r) for r in several_chunks(chunks).collect())
    assert got == [("1", "b", 5), ("1", "b", 5), ("2", "a", 0), ("2", "a", 1)]


def test_only_inputs_of_few_splits_are_rebalanced(spark):
    many = spark.range(100, numPartitions=16)
    assert spread(many, "id").rdd.getNumPartitions() == 16
    few = spread(spark.range(100, numPartitions=1), "id")
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert few.count() == 100
