"""Quality selection by importance resampling of hashed n-gram features.

Words and runs of punctuation, and pairs of neighbours, are hashed to 16,384
counters. Two generative models, target text and raw text, are the smoothed
shares of those counters; a document's log importance weight is the sum over its
features of the log ratio. Adding Gumbel noise seeded by a hash of the document
and keeping the ``k`` largest keys draws ``k`` documents without replacement in
proportion to their weights.

Edge cases: a null or empty text has weight 0; documents whose key equals the
k-th largest are all kept, so repeated rows (one id, one text) share one fate;
without target rows all weights are 0 and the draw is uniform; an empty table
gives no rows. Only ``doc_id`` and ``text`` are read of the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundglean.llm.common import checkpoint, column, mixed, row_key, word_codes

BUCKETS = 1 << 14
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff\x20\x09-\x0d]+")
#: Bound of the labelled sample that stands for the target.
MAX_TARGET = 20_000
#: Buckets of a histogram while the k-th largest is sought.
PARTS = 4096


def features(raw: bytes | None) -> np.ndarray:
    """Counter numbers of the words and word pairs of a text."""
    if not raw:
        return np.zeros(0, np.int64)
    code = word_codes(TOKEN.findall(raw.lower()))
    pair = mixed(code[:-1] * np.uint64(3) + code[1:])
    return (np.concatenate([mixed(code), pair]) >> np.uint64(50)).astype(np.int64)


def model_counts(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """Counts of the features over the target and over all documents (two rows)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for raw, wanted in zip(column(batch, 0), column(batch, 1), strict=True):
                own = np.bincount(features(raw), minlength=BUCKETS)
                total[1] += own
                if wanted:
                    total[0] += own
        kind, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(total[kind, at])],
            ["kind", "counter", "n"],
        )

    marked = docs.select("doc_id", "text").join(
        F.broadcast(target.select("doc_id", F.lit(True).alias("_wanted"))), "doc_id", "left"
    )
    sums = (
        marked.select("text", "_wanted")
        .mapInArrow(count, "kind int, counter int, n long")
        .groupBy("kind", "counter")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros((2, BUCKETS))
    for kind, at, n in sums:
        counts[kind, at] = n
    return counts


def log_ratio(counts: np.ndarray) -> np.ndarray:
    if not counts[0].any():
        return np.zeros(BUCKETS)
    share = (counts + 1.0) / (counts + 1.0).sum(1, keepdims=True)
    return np.log(share[0]) - np.log(share[1])


def log_weight(ratio: np.ndarray) -> Column:
    @F.pandas_udf("double")
    def weight(texts: pd.Series) -> pd.Series:
        return pd.Series([float(ratio[features(raw)].sum()) for raw in texts], dtype="float64")

    return weight.asNondeterministic()(F.col("text").cast("binary"))


def gumbel(seed: int, *columns: str) -> Column:
    bits = F.xxhash64(F.lit(seed), row_key(*columns)).bitwiseAND(F.lit((1 << 52) - 1))
    return -F.log(-F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))))


def kth_largest(values: DataFrame, name: str, k: int) -> float:
    """The ``k``-th largest value, by histograms of ever narrower ranges; no sort.

    Only counts and bounds of at most ``PARTS`` buckets come to the driver.
    """
    low, high = values.agg(F.min(name), F.max(name)).first()
    ahead = 0  # values above ``high``
    while low < high:
        inside = values.where(F.col(name).between(low, high))
        width = (high - low) / PARTS
        part = F.least(F.floor((F.col(name) - low) / width), F.lit(PARTS - 1))
        rows = (
            inside.groupBy(part.alias("part"))
            .agg(F.count(F.lit(1)), F.min(name), F.max(name))
            .orderBy(F.desc("part"))
            .collect()
        )
        for _, n, least, most in rows:
            if ahead + n >= k:
                low, high = least, most
                break
            ahead += n
    return high


def importance_sample(
    docs: DataFrame, target: DataFrame, keep: tuple[int, int], seed: int = 17
) -> DataFrame:
    """``doc_id``, ``log_weight``, ``sample_key`` and ``kept`` of every document.

    ``target`` has the distinct ids of target documents, at most ``MAX_TARGET``;
    the share ``keep`` (numerator, denominator) of all documents is kept.
    """
    ratio = log_ratio(model_counts(docs, target))
    weighed = checkpoint(
        docs.select("doc_id", row_key("doc_id", "text").alias("_key"), log_weight(ratio).alias("log_weight"))
        .select(
            "doc_id",
            "log_weight",
            (F.col("log_weight") + gumbel(seed, "_key")).alias("sample_key"),
        )
    )
    n = weighed.count()
    k = n * keep[0] // max(1, keep[1])
    if not k:
        return weighed.withColumn("kept", F.lit(False))
    return weighed.withColumn(
        "kept", F.col("sample_key") >= F.lit(kth_largest(weighed, "sample_key", k))
    )


def labelled_target(labels: DataFrame, bound: int = MAX_TARGET) -> tuple[DataFrame, tuple[int, int]]:
    """Ids of at most ``bound`` good documents, by hash, and the share of good ones."""
    each = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    good, n = each.agg(F.count_if(F.col("quality") > 0), F.count(F.lit(1))).first()
    ids = each.where("quality > 0").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
    return ids.limit(bound), (good, n)
