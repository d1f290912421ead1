"""Request batches of each filing's chunks, by token budget and count."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundglean.functions.binding import let
from fundglean.operators.lineage import cut_lineage
from fundglean.operators.skew import salted_join
from fundglean.schemas import FILING_KEYS

TEXT_HASH = "text_hash"
FOLD_LIMIT = 50_000
SEGMENT = 4096


def batch_starts(tokens: Column, max_tokens: int, max_chunks: int) -> Column:
    """0-based positions at which a new batch begins; a batch is never empty."""
    zero = F.struct(
        F.lit(0).cast("long").alias("used"),
        F.lit(0).alias("count"),
        F.lit(0).alias("at"),
        F.array().cast("array<int>").alias("starts"),
    )

    def step(state: Column, size: Column) -> Column:
        full = (
            (state["at"] == 0)
            | (state["count"] >= max_chunks)
            | (state["used"] + size > max_tokens)
        )
        return F.struct(
            F.when(full, size.cast("long")).otherwise(state["used"] + size).alias("used"),
            F.when(full, 1).otherwise(state["count"] + 1).alias("count"),
            (state["at"] + 1).alias("at"),
            F.when(full, F.array_append(state["starts"], state["at"]))
            .otherwise(state["starts"])
            .alias("starts"),
        )

    return F.aggregate(tokens, zero, step, lambda state: state["starts"])


def token_batches(
    chunks: DataFrame,
    tokens: Column,
    max_tokens: int,
    max_chunks: int,
    fold_limit: int = FOLD_LIMIT,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``batch_id`` of every chunk, counted from 0 in chunk order within its filing.

    Columns of ``carry`` go along.

    A filing of ordinary length is folded within one row. Filings of more than
    ``fold_limit`` chunks go through :func:`_by_segments`, with the same result.
    A NULL token count is 0. Which filings are long is told by their keys alone;
    tokens are counted once, and written out if both ways need them.
    """
    keys = list(FILING_KEYS)
    count = F.coalesce(tokens.cast("int"), F.lit(0))
    sized = chunks.select(*keys, "chunk_num", count.alias("tokens"), *carry)
    lengths = chunks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    long = lengths.where(F.col("n") > fold_limit).select(*keys)
    if long.isEmpty():
        return _in_one_row(sized, max_tokens, max_chunks, carry)
    sized, long = cut_lineage(sized), cut_lineage(long)
    return _in_one_row(
        salted_join(sized, long, keys, "left_anti"), max_tokens, max_chunks, carry
    ).unionByName(
        _by_segments(
            salted_join(sized, long, keys, "left_semi"), max_tokens, max_chunks, carry=carry
        )
    )


def requests(
    chunks: DataFrame, text: str, tokens: Column, max_tokens: int, max_chunks: int
) -> DataFrame:
    """One row for each request: keys, ``batch_id``, and ``items`` (chunk_num, text) in order.

    Batches are told from token counts and hashes of the texts; the texts themselves meet
    their batch by filing and chunk number, and only those of one request stand in a
    row. Copies of a chunk are told apart by their number.
    """
    keys = [*FILING_KEYS, "chunk_num", TEXT_HASH]
    texts = chunks.select(*keys[:-1], F.col(text).alias("text"), tokens.alias("tokens")).withColumn(
        TEXT_HASH, F.xxhash64("text")
    )
    batched = token_batches(texts, F.col("tokens"), max_tokens, max_chunks, carry=[TEXT_HASH])
    copies = Window.partitionBy(*keys)
    numbered = batched.withColumn("copy", F.row_number().over(copies.orderBy("batch_id")))
    own = texts.drop("tokens").withColumn("copy", F.row_number().over(copies.orderBy("text")))
    met = own.join(numbered.select(*keys, "copy", "batch_id"), [*keys, "copy"])
    items = F.sort_array(F.collect_list(F.struct("chunk_num", "text")))
    return met.groupBy(*FILING_KEYS, "batch_id").agg(items.alias("items"))


def _in_one_row(
    sized: DataFrame, max_tokens: int, max_chunks: int, carry: Sequence[str] = ()
) -> DataFrame:
    keys = list(FILING_KEYS)
    filings = sized.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("chunk_num", "tokens", *carry))).alias("items")
    )

    def labelled(starts: Column) -> Column:
        runs = F.transform(
            starts,
            lambda start, k: F.transform(
                F.slice(
                    "items",
                    start + 1,
                    F.coalesce(F.get(starts, k + 1), F.size("items")) - start,
                ),
                lambda item: F.struct(
                    item["chunk_num"].alias("chunk_num"),
                    item["tokens"].alias("tokens"),
                    *[item[c].alias(c) for c in carry],
                    k.alias("batch_id"),
                ),
            ),
        )
        return F.flatten(runs)

    starts = batch_starts(
        F.transform("items", lambda item: item["tokens"]), max_tokens, max_chunks
    )
    return filings.select(*keys, F.inline(let(starts, labelled)))


def _next_starts(tokens: np.ndarray, max_tokens: int, max_chunks: int) -> np.ndarray:
    """For a batch that begins at each position, where the following one begins."""
    total = np.concatenate(([0], np.cumsum(tokens, dtype=np.int64)))
    here = np.arange(len(tokens))
    full = np.searchsorted(total[1:], total[:-1] + max_tokens, side="right")
    following = np.maximum(np.minimum(full, here + max_chunks), here + 1)
    return np.minimum(following, len(tokens))


def _by_segments(
    sized: DataFrame,
    max_tokens: int,
    max_chunks: int,
    segment: int = SEGMENT,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Batches of very long filings, without one task seeing a whole filing.

    A filing is cut into segments of equal length, no shorter than the longest
    batch. A segment is summed up by a map from the position at which a batch
    starts in it to the position of the first start in the next segment. These
    maps are composed pairwise, level by level, and then followed downwards from
    the start of the filing (a parallel prefix), which gives each segment its
    first start; the rest is local to the segment.
    """
    keys = list(FILING_KEYS)
    length = max(segment, max_chunks)

    @F.pandas_udf("array<int>")
    def crossings(tokens: pd.Series, ahead: pd.Series) -> pd.Series:
        def one(own, after):
            both = np.concatenate((np.asarray(own), np.asarray(after)))
            jump = _next_starts(both, max_tokens, max_chunks)
            to = jump[: len(own)]
            while (to < len(own)).any():
                to = np.where(to < len(own), jump[np.minimum(to, len(own) - 1)], to)
            return (to - len(own)).astype(np.int32)

        return pd.Series([one(a, b) for a, b in zip(tokens, ahead)], dtype=object)

    @F.pandas_udf("array<int>")
    def starts_so_far(tokens: pd.Series, entry: pd.Series) -> pd.Series:
        def one(own, at):
            jump = _next_starts(np.asarray(own), max_tokens, max_chunks)
            begins = np.zeros(len(own), dtype=np.int32)
            while at < len(own):
                begins[at] = 1
                at = jump[at]
            return np.cumsum(begins, dtype=np.int32)

        return pd.Series([one(a, b) for a, b in zip(tokens, entry)], dtype=object)

    # positions in the filing, from counts of chunk-number ranges
    ranged = sized.withColumn("part", F.floor(F.col("chunk_num") / length))
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        ranged.groupBy(*keys, "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    in_part = Window.partitionBy(*keys, "part").orderBy("chunk_num", "tokens", *carry)
    placed = ranged.join(offsets, [*keys, "part"]).withColumn(
        "at", F.col("before") + F.row_number().over(in_part) - 1
    )
    segments = cut_lineage(
        placed.groupBy(*keys, F.floor(F.col("at") / length).alias("seg")).agg(
            F.sort_array(F.collect_list(F.struct("at", "chunk_num", "tokens", *carry))).alias("items")
        )
    )
    own = F.transform("items", lambda item: item["tokens"])
    tokens = segments.select(*keys, "seg", own.alias("tokens"))

    def after(df: DataFrame, step: int, name: str) -> DataFrame:
        """Rows of ``df`` as seen from ``step`` segments before."""
        return df.select(*keys, (F.col("seg") - step).alias("seg"), F.col(name).alias("ahead"))

    level = cut_lineage(
        tokens.join(after(tokens, 1, "tokens"), [*keys, "seg"]).select(
            *keys, "seg", crossings("tokens", "ahead").alias("jump")
        )
    )
    last = segments.agg(F.max("seg")).first()[0]
    levels = [level]
    while 2 ** len(levels) <= last:
        step = 2 ** (len(levels) - 1)
        pairs = level.where(F.col("seg") % (2 * step) == 0).join(
            after(level, step, "jump"), [*keys, "seg"]
        )
        level = cut_lineage(
            pairs.select(
                *keys,
                "seg",
                F.transform("jump", lambda s: F.get("ahead", s)).alias("jump"),
            )
        )
        levels.append(level)

    entries = segments.where(F.col("seg") == 0).select(*keys, "seg", F.lit(0).alias("entry"))
    for depth in reversed(range(len(levels))):
        found = entries.join(levels[depth], [*keys, "seg"]).select(
            *keys,
            (F.col("seg") + 2**depth).alias("seg"),
            F.get("jump", F.col("entry")).alias("entry"),
        )
        entries = cut_lineage(entries.unionByName(found))

    begun = F.col("begun")
    counted = segments.join(entries, [*keys, "seg"]).withColumn(
        "begun", starts_so_far(own, "entry")
    )
    before = Window.partitionBy(*keys).orderBy("seg").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = cut_lineage(counted)
    batches_before = counts.select(
        *keys,
        "seg",
        F.coalesce(F.sum(F.element_at(begun, -1)).over(before), F.lit(0)).alias("so_far"),
    )
    labelled = F.zip_with(
        "items",
        begun,
        lambda item, count: F.struct(
            item["chunk_num"].alias("chunk_num"),
            item["tokens"].alias("tokens"),
            *[item[c].alias(c) for c in carry],
            (F.col("so_far") + count - 1).cast("int").alias("batch_id"),
        ),
    )
    return counts.join(batches_before, [*keys, "seg"]).select(*keys, F.inline(labelled))
