"""Abbreviations of a corpus: words that a period follows more than chance would have it.

The words of all texts are counted by whether a period follows. A word and the period
belong together by their log-likelihood ratio: how much better the counts fit a word that
nearly always has its period than one that has it as often as any other word. Long words,
and words that stand without a period too, count for less (Kiss and Strunk's measure).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The chance of a period after an abbreviation, and the least score of one.
ALWAYS = 0.99
LEAST_SCORE = 0.3
MOST = 10_000  # words of the model, the best ones


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """``word`` in lower case, and how often it stands ``dotted`` and ``bare``."""
    words = F.regexp_extract_all(F.lower(F.col(column)), F.lit(r"(\p{L}+\.?)"))
    each = texts.select(F.explode(words).alias("said"))
    return each.groupBy(F.rtrim(F.col("said"), F.lit(".")).alias("word")).agg(
        F.count_if(F.endswith("said", F.lit("."))).alias("dotted"),
        F.count_if(~F.endswith("said", F.lit("."))).alias("bare"),
    )


def scores(texts: DataFrame, column: str, least: float = LEAST_SCORE) -> DataFrame:
    """The abbreviations: ``word``, ``dotted``, ``bare`` and ``score``."""
    counts = word_counts(texts, column)
    totals = counts.agg(
        F.sum("dotted").alias("periods"), F.sum(F.col("dotted") + F.col("bare")).alias("words")
    )
    share = F.col("periods") / F.col("words")

    def likelihood(chance) -> Column:
        return F.col("dotted") * F.ln(chance) + F.col("bare") * F.ln(1 - chance)

    ratio = 2 * (likelihood(F.lit(ALWAYS)) - likelihood(share))
    length = F.length("word")
    score = ratio * F.exp(-length) * F.pow(length.cast("double"), -F.col("bare"))
    dotted = counts.where("dotted > 0").join(F.broadcast(totals.where("words > periods")))  # one row
    return dotted.select("word", "dotted", "bare", score.alias("score")).where(F.col("score") >= least)


def learned(texts: DataFrame, column: str, least: float = LEAST_SCORE, most: int = MOST) -> list[str]:
    """The model: up to ``most`` words, the best first, for ``sentences``."""
    best = scores(texts, column, least).orderBy(F.desc("score"), "word").limit(most)
    return [row.word for row in best.collect()]
