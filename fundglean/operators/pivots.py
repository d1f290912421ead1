"""Exact vector search that leaves out what the triangle inequality rules out.

Vectors of length one have distances that obey the triangle inequality, and the nearer two
of them are by it, the smaller is their cosine distance. Some vectors of a sample serve
as pivots; each vector belongs to its nearest pivot, and to a ring of vectors about as far
from it. How far a phrase is from the pivot, and the ring's least and largest distances,
bound the distances of all its vectors from the phrase. For each filing the bounds tell a
distance within which there are enough pairs for sure; rings that lie beyond it are
skipped, all vectors of the others are scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundglean.functions.vectors import cosine_distance
from fundglean.operators import search
from fundglean.operators.filters import with_tag
from fundglean.operators.lineage import cut_lineage
from fundglean.operators.skew import salted_join
from fundglean.schemas import FILING_KEYS

#: The pivots are fitted on so many vectors at most, drawn by a hash of their keys.
SAMPLE = 4096
PIVOTS = 64
RING = 0.05  # width of a ring
SLACK = 1e-7  # more than distances can be off
PAIR = "pivot int, distance double"


def units(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose vector has ``size`` numbers and is not zero, and these vectors at length one."""
    rows, matrix = search._matrices(column).get(size, (np.zeros(0, int), np.zeros((0, size))))
    norms = np.linalg.norm(matrix, axis=1)
    kept = norms > 0  # False for NaN
    return rows[kept], matrix[kept] / norms[kept, None]


def apart(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * vectors @ pivots.T))


def fitted(vectors: DataFrame, n: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Pivots: vectors of the sample, each the farthest from those before it."""
    order = [F.xxhash64(*FILING_KEYS, "chunk_num"), *FILING_KEYS, "chunk_num"]
    drawn = vectors.where("embedding IS NOT NULL").orderBy(*order).limit(sample)
    rows = [r.embedding for r in drawn.select("embedding").collect()]
    sizes = np.array([len(r) for r in rows])
    if not sizes.any():
        return np.zeros((0, 0))
    size = int(np.bincount(sizes).argmax())
    _, found = units(pa.array(rows, pa.list_(pa.float64())), size)
    if not len(found):
        return np.zeros((0, size))
    chosen = [0]
    near = apart(found, found[:1])[:, 0]
    while len(chosen) < min(n, len(found)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, apart(found, found[chosen[-1:]])[:, 0])
    return found[chosen]


def placed(embedding: str, pivots: np.ndarray) -> Column:
    """The nearest pivot and the distance from it; NULL for vectors that have none."""

    @F.arrow_udf(PAIR)
    def nearest(column: pa.Array) -> pa.Array:
        at = np.full(len(column), -1)
        far = np.zeros(len(column))
        rows, vectors = units(column, pivots.shape[1])
        if len(rows) and len(pivots):
            distances = apart(vectors, pivots)
            at[rows] = distances.argmin(axis=1)
            far[rows] = distances.min(axis=1)
        none = at < 0
        arrays = [pa.array(at.astype(np.int32), mask=none), pa.array(far, mask=none)]
        return pa.StructArray.from_arrays(arrays, names=["pivot", "distance"])

    return nearest(embedding)


def from_pivots(embedding: str, pivots: np.ndarray) -> Column:
    """Distances from all pivots, NULL for vectors that have none."""

    @F.arrow_udf("array<double>")
    def all_distances(column: pa.Array) -> pa.Array:
        out: list = [None] * len(column)
        rows, vectors = units(column, pivots.shape[1])
        for row, distances in zip(rows.tolist(), apart(vectors, pivots).tolist(), strict=True):
            out[row] = distances
        return pa.array(out, pa.list_(pa.float64()))

    return all_distances(embedding)


def ringed(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Vectors with ``pivot``, ``ring`` and ``away``, the distance from the pivot."""
    named = vectors.select(*FILING_KEYS, "chunk_num", "embedding", placed("embedding", pivots).alias("p"))
    return named.select(
        *FILING_KEYS, "chunk_num", "embedding", F.col("p.pivot").alias("pivot"),
        F.floor(F.col("p.distance") / RING).cast("int").alias("ring"), F.col("p.distance").alias("away"),
    )


def rings_to_score(rings: DataFrame, asked: DataFrame, depth: int) -> DataFrame:
    """Rings and phrases that may hold one of the ``depth`` nearest pairs of their filing.

    ``rings`` has keys, ``pivot``, ``ring``, its number of vectors ``n`` and the least and
    largest distance from the pivot, ``low`` and ``high``; ``asked`` phrases with their
    distance from each pivot.
    """
    bounds = rings.join(asked, "pivot")
    least = F.greatest(F.lit(0.0), F.col("from_pivot") - F.col("high"), F.col("low") - F.col("from_pivot"))
    most = F.col("from_pivot") + F.col("high")
    # Enough pairs lie within the first bound up to which the rings hold so many.
    by_most = Window.partitionBy(*FILING_KEYS).orderBy("most")
    filing = Window.partitionBy(*FILING_KEYS)
    counted = bounds.withColumns({"least": least, "most": most})
    counted = counted.withColumn("upto", F.sum("n").over(by_most))
    enough = F.min(F.when(F.col("upto") >= depth, F.col("most"))).over(filing)
    limit = F.coalesce(enough, F.lit(float("inf")))
    kept = counted.withColumn("limit", limit).where(F.col("least") <= F.col("limit") + SLACK)
    return kept.select(*FILING_KEYS, "pivot", "ring", "number", "n")


def search_plan(
    vectors: DataFrame, phrases: DataFrame, depth: int, pivots: np.ndarray
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Ringed vectors, rings, numbered phrases, and the rings to score by phrase."""
    own = ringed(vectors, pivots)
    rings = (
        own.where("pivot IS NOT NULL")
        .groupBy(*FILING_KEYS, "pivot", "ring")
        .agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("low"), F.max("away").alias("high"))
    )
    numbered = phrases.select(
        F.monotonically_increasing_id().alias("number"), "phrase", "phrase_embedding"
    )
    numbered = cut_lineage(numbered)
    asked = numbered.select(
        "number", F.posexplode(from_pivots("phrase_embedding", pivots)).alias("pivot", "from_pivot")
    )
    return own, rings, numbered, rings_to_score(rings, asked, depth)


def top_pairs(
    vectors: DataFrame,
    phrases: DataFrame,
    tag: str,
    depth: int = search.DEFAULT_DEPTH,
    n_pivots: int = PIVOTS,
    sample: int = SAMPLE,
    shipped_bytes: int = search.SHIPPED_BYTES,
) -> DataFrame:
    """As :func:`fundglean.operators.search.top_pairs`, with the same rows.

    For phrase sets of up to ``shipped_bytes``, which go to every task; larger ones are
    searched without pivots. Vectors of other lengths than most are scored all.
    """
    asked = with_tag(phrases, tag).select("phrase", "phrase_embedding").where("phrase_embedding IS NOT NULL")
    count, longest = asked.agg(F.count(F.lit(1)), F.max(F.size("phrase_embedding"))).first()
    pivots = fitted(vectors, n_pivots, sample)
    if count * 8 * (longest or 0) > shipped_bytes or not len(pivots):
        return search.top_pairs(vectors, phrases, tag, depth, shipped_bytes)
    own, _, numbered, kept = search_plan(vectors, asked, depth, pivots)
    near = salted_join(own.where("pivot IS NOT NULL"), kept.drop("n"), [*FILING_KEYS, "pivot", "ring"], "inner")
    scored = near.join(F.broadcast(numbered), "number").withColumn(
        "distance", cosine_distance(F.col("embedding"), F.col("phrase_embedding"))
    )
    pairs = scored.where("distance IS NOT NULL").withColumn(
        "rank_distance", F.round("distance", search.RANK_DIGITS) + F.lit(0.0)
    )
    names = [*FILING_KEYS, "chunk_num", "phrase", "rank_distance", "distance"]
    others = own.where("pivot IS NULL")
    rest = search.phrase_distances(others, asked, depth, shipped_bytes).select(*names)
    found = pairs.select(*names).unionAll(rest)
    return search.limit_per_group(
        found, FILING_KEYS, ("rank_distance", "chunk_num", "phrase"), depth
    ).select(*FILING_KEYS, "phrase", "chunk_num", "distance")


def scored_share(
    vectors: DataFrame, phrases: DataFrame, tag: str, depth: int, n_pivots: int = PIVOTS, sample: int = SAMPLE
) -> DataFrame:
    """``n_pairs`` of vectors and phrases, and ``n_scored``, how many of them are scored."""
    asked = with_tag(phrases, tag).select("phrase", "phrase_embedding").where("phrase_embedding IS NOT NULL")
    _, rings, numbered, kept = search_plan(vectors, asked, depth, fitted(vectors, n_pivots, sample))
    scored = kept.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_scored"))
    total = rings.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    count = numbered.count()
    return total.select((F.col("n") * count).alias("n_pairs")).join(F.broadcast(scored))
