"""Mixing sources to target weights by Poisson replication.

Each source gets a target share of the mix. Its mean repetition rate is the target
number of its rows over the number it has; each document's count is drawn by
inverting the Poisson distribution of that mean at a uniform number hashed from the
document and the seed. A mean over ``MAX_RATE`` is drawn in equal parts, whose sum has
the same distribution. Documents are exploded by their counts, and the copies are
laid out in the order of a hash of document and copy: a global shuffle.

Only per-source figures are collected, ``MAX_SOURCES`` rows at most; with more sources
the rates are joined by source, salted so that no source's rows meet in one task.

Edge cases: a null source is a source of its own; sources that ``weights`` does not
name get weight ``other``; a weight of zero leaves a source out; equal rows (id, text
and source) draw equal counts and one place in the order; an empty table gives no rows. Columns
of the documents named like the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundglean.functions.binding import let
from fundglean.llm.common import checkpoint, fresh

MAX_SOURCES = 10_000
SALTS = 64
#: Largest mean that is inverted at once, and copies in one row before the last explode.
MAX_RATE = 256.0
BLOCK = 4096
DIGITS = 13  # hex digits of a hash that make a uniform number
KEY_DIGITS = 15


def hashed(digits: int, seed: int, *columns: Column) -> Column:
    """The first hex digits of md5 over the seed and the columns, as a long."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def rates(docs: DataFrame, weights: Mapping[str, float] | None, other: float, epochs: float) -> DataFrame:
    """``source``, ``rate``: mean repetitions of a row of each source."""
    sizes = checkpoint(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")))
    weight = F.lit(float(other))
    for name, value in (weights or {}).items():
        weight = F.when(F.col("source") == name, float(value)).otherwise(weight)
    weighed = sizes.withColumn("weight", weight)
    weights_sum, rows = weighed.agg(F.sum("weight"), F.sum("n")).first()
    if not weights_sum:
        return weighed.select("source", F.lit(0.0).alias("rate"))
    share = F.col("weight") / F.lit(weights_sum)
    rate = share * F.lit(float(epochs)) * F.lit(rows) / F.col("n")
    return weighed.select("source", rate.alias("rate"))


def cumulative(rate: Column) -> Column:
    """P(count <= k) for k from 0 to where what is left is below a hash's last bit."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(
        F.array(F.exp(-rate)).alias("sums"), F.lit(0.0).cast("double").alias("log_factorial")
    )

    def add(state: Column, k: Column) -> Column:
        log_factorial = state["log_factorial"] + F.log(k.cast("double"))
        term = F.exp(k * F.log(rate) - rate - log_factorial)
        sums = F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + term))
        return F.struct(sums.alias("sums"), log_factorial.alias("log_factorial"))

    sums = F.aggregate(F.sequence(F.lit(1), last), start, add, lambda state: state["sums"])
    return F.when(rate > 0, sums).otherwise(F.array(F.lit(1.0)))


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    other: float = 1.0,
    epochs: float = 1.0,
    seed: int = 11,
) -> DataFrame:
    """The documents' columns with ``copy`` (from 1) and ``shuffle_key``, in order of the latter.

    The mix has about ``epochs`` times as many rows as ``docs``, shared out by weight.
    """
    rated = rates(docs, weights, other, epochs)
    parts = F.greatest(F.ceil(F.col("rate") / MAX_RATE), F.lit(1)).cast("int")
    per_source = rated.withColumn("parts", parts).withColumn(
        "draw", F.struct("parts", cumulative(F.col("rate") / F.col("parts")).alias("chances"))
    )
    own = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    source, draw, salt = (fresh(docs, x) for x in ("mix_source", "mix_draw", "mix_salt"))
    lookup = per_source.select(F.col("source").alias(source), F.col("draw").alias(draw))
    if per_source.select("source").limit(MAX_SOURCES + 1).count() <= MAX_SOURCES:
        joined = docs.join(F.broadcast(lookup), F.col("source").eqNullSafe(F.col(source)))
    else:
        salted = docs.withColumn(salt, F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)))
        other_salt = f"{salt}_"
        every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        many = lookup.select("*", every.alias(other_salt))
        same = F.col("source").eqNullSafe(F.col(source)) & (F.col(salt) == F.col(other_salt))
        joined = salted.join(many, same)
    identity = F.md5(F.concat_ws("|", *[
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "source", "text")
    ]))
    who, u = fresh(docs, "mix_identity"), fresh(docs, "mix_count")

    def one(part: Column) -> Column:
        """How many of the sums a number reaches: the count whose chance interval it lies in."""
        number = hashed(DIGITS, seed, F.col(who), part) / F.lit(float(16**DIGITS))
        return let(number, lambda x: F.size(F.filter(F.col(draw)["chances"], lambda c: c <= x)))

    every_part = F.sequence(F.lit(1), F.col(draw)["parts"])
    count = F.aggregate(every_part, F.lit(0), lambda n, part: n + one(part))
    copies = joined.withColumn(who, identity).withColumn(u, count).where(F.col(u) > 0)
    first = fresh(docs, "mix_first")
    blocks = F.explode(F.sequence(F.lit(1), F.col(u), F.lit(BLOCK))).alias(first)
    upto = F.least(F.col(first) + (BLOCK - 1), F.col(u))
    numbers = F.explode(F.sequence(F.col(first), upto)).alias("copy")
    exploded = copies.select(*own, who, u, blocks).select(*own, who, numbers)
    key = hashed(KEY_DIGITS, seed, F.col(who), F.col("copy")).alias("shuffle_key")
    laid_out = exploded.select(*own, "copy", key).repartitionByRange("shuffle_key")
    return laid_out.sortWithinPartitions("shuffle_key")


def sql(seed: int = 11) -> str:
    """SQL for ``mix(documents)`` with equal weights, one epoch and no mean over ``MAX_RATE``."""
    return f"""
WITH sizes AS (
    SELECT source, count(*) AS n FROM documents GROUP BY source
), rated AS (
    SELECT source, 1.0 / (SELECT count(*) FROM sizes) * (SELECT count(*) FROM documents) / n AS rate
    FROM sizes
), steps AS (
    SELECT source, rate, unnest(range(0, CAST(ceil(rate + 10 * sqrt(rate) + 20) AS BIGINT) + 1)) AS k
    FROM rated
), factorials AS (
    SELECT *, sum(CASE WHEN k = 0 THEN 0.0 ELSE ln(k) END)
        OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS log_factorial
    FROM steps
), chances AS (
    SELECT source, k, sum(exp(k * ln(rate) - rate - log_factorial))
        OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS upto
    FROM factorials
), named AS (
    SELECT *, md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(source, ''),
        coalesce(text, ''))) AS who
    FROM documents
), drawn AS (
    SELECT *, CAST('0x' || substr(md5('{seed}|' || who || '|1'), 1, {DIGITS}) AS BIGINT) / {float(16**DIGITS)} AS u
    FROM named
), counted AS (
    SELECT d.*, (SELECT count(*) FROM chances c
                 WHERE c.source IS NOT DISTINCT FROM d.source AND c.upto <= d.u) AS n_copies
    FROM drawn d
), copies AS (
    SELECT doc_id, text, lang, source, n_chars, who,
        CAST(unnest(range(1, n_copies + 1)) AS INTEGER) AS copy
    FROM counted
)
SELECT doc_id, text, lang, source, n_chars, copy,
    CAST('0x' || substr(md5('{seed}|' || who || '|' || copy), 1, {KEY_DIGITS}) AS BIGINT) AS shuffle_key
FROM copies
"""
