"""Score and rank the chunks of each filing, then pick chunk lists by four rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundglean.schemas import FILING_KEYS

PICKED = 3
RANK_DIGITS = 12

# The selection rules in the order they are tried.
METHODS = ("distance", "appearance", "distance-any3", "appearance-any3")


def chunk_scores(pairs: DataFrame) -> DataFrame:
    """Per chunk: frequency, average and minimum distance, both scores and ranks.

    ``pairs`` come hash-partitioned by filing from the search, which already
    satisfies this aggregation and its windows: no further exchange.
    """
    scored = (
        pairs.groupBy(*FILING_KEYS, "chunk_num")
        .agg(
            F.count("distance").alias("frequency"),
            F.avg("distance").alias("avg_distance"),
            F.min("distance").alias("min_distance"),
        )
        .withColumn("distance_score", 1 / (1 + F.col("avg_distance")))
        .withColumn("appearance_score", F.col("frequency") / (1 + F.col("avg_distance")))
    )

    def rank(score: str) -> Column:
        order = Window.partitionBy(*FILING_KEYS).orderBy(
            F.round(score, RANK_DIGITS).desc(),
            F.round("min_distance", RANK_DIGITS),
            "chunk_num",
        )
        return F.row_number().over(order)

    return scored.withColumn("distance_rank", rank("distance_score")).withColumn(
        "appearance_rank", rank("appearance_score")
    )


def _leading(rank: str) -> Column:
    """Chunk numbers of ranks 1 to 3, best first."""
    entry = F.when(F.col(rank) <= PICKED, F.struct(rank, "chunk_num"))
    return F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["chunk_num"])


def adjacent(leading: Column) -> Column:
    """Rank 1, and ranks 2 and 3 only where they stand next to rank 1."""
    best = F.get(leading, 0)
    return F.array_sort(
        F.array_distinct(
            F.filter(leading, lambda chunk, i: (i == 0) | (F.abs(chunk - best) == 1))
        )
    )


def selections(scores: DataFrame) -> DataFrame:
    """One row per filing with ``choices``: array of (ordinal, method, chunks).

    A rule that picks a list an earlier rule already picked is left out.
    """
    ranked = scores.where(
        (F.col("distance_rank") <= PICKED) | (F.col("appearance_rank") <= PICKED)
    )
    led = ranked.groupBy(*FILING_KEYS).agg(
        _leading("distance_rank").alias("by_distance"),
        _leading("appearance_rank").alias("by_appearance"),
    )
    lists = (
        adjacent(F.col("by_distance")),
        adjacent(F.col("by_appearance")),
        F.array_sort("by_distance"),
        F.array_sort("by_appearance"),
    )
    choices = F.array(
        *[
            F.struct(F.lit(i).alias("ordinal"), F.lit(m).alias("method"), c.alias("chunks"))
            for i, (m, c) in enumerate(zip(METHODS, lists))
        ]
    )
    all_choices = led.select(*FILING_KEYS, choices.alias("all_choices"))
    return all_choices.select(
        *FILING_KEYS,
        F.filter(
            "all_choices",
            lambda c: ~F.exists(
                "all_choices",
                lambda e: (e["ordinal"] < c["ordinal"]) & (e["chunks"] == c["chunks"]),
            ),
        ).alias("choices"),
    )


def selected_chunks(scores: DataFrame, method: str) -> DataFrame:
    """Per filing the chunk list of one rule, whether or not another rule agrees."""
    rank = "appearance_rank" if method.startswith("appearance") else "distance_rank"
    led = scores.where(F.col(rank) <= PICKED).groupBy(*FILING_KEYS).agg(
        _leading(rank).alias("leading")
    )
    pick = F.array_sort if method.endswith("any3") else adjacent
    return led.select(*FILING_KEYS, pick(F.col("leading")).alias("selected_chunks"))
