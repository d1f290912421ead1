"""Vector arithmetic in DOUBLE on array columns, and a model-free text vector."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundglean.functions.binding import let


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(
        F.aggregate(
            a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
        )
    )


def cosine_distance(a: Column, b: Column, norm_a: Column | None = None,
                    norm_b: Column | None = None) -> Column:
    """``1 - a.b / (|a| |b|)``; NULL if either vector is all zeros."""
    norm_a = norm(a) if norm_a is None else norm_a
    norm_b = norm(b) if norm_b is None else norm_b
    return 1 - dot(a, b) / F.nullif(norm_a * norm_b, F.lit(0.0))


def word_bucket(word: Column, dimension: int) -> Column:
    """0-based bucket of a word, from its CRC-32."""
    return F.pmod(F.crc32(word), F.lit(dimension)).cast("int")


def bucket_counts(buckets: Column, dimension: int) -> Column:
    """Dense histogram of an array of bucket numbers, from the runs of the sorted array."""

    def zeros(n: Column) -> Column:
        return F.array_repeat(F.lit(0.0), n.cast("int"))

    def run_starts(ordered: Column) -> Column:
        begins = F.transform(
            ordered, lambda b, i: F.when((i == 0) | (F.get(ordered, i - 1) != b), i)
        )
        return F.array_compact(begins)

    def dense(ordered: Column, starts: Column) -> Column:
        def entry(at: Column, k: Column) -> Column:
            before = F.when(at > 0, F.get(ordered, at - 1)).otherwise(F.lit(-1))
            after = F.coalesce(F.get(starts, k + 1), F.size(ordered))
            count = F.array((after - at).cast("double"))
            return F.concat(zeros(F.get(ordered, at) - before - 1), count)

        last = F.coalesce(F.get(ordered, F.size(ordered) - 1), F.lit(-1))
        return F.concat(
            F.flatten(F.transform(starts, entry)), zeros(dimension - 1 - last)
        )

    return let(
        F.sort_array(buckets),
        lambda ordered: let(run_starts(ordered), lambda starts: dense(ordered, starts)),
    )


def hash_embedding(text: Column, dimension: int) -> Column:
    """Feature-hash vector of unit length: bucket counts of the lower-cased words.

    Stands in for a hosted model, so that jobs and tests run offline. A text
    without words gives the zero vector. All of it happens inside the row: no
    explode, no shuffle.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), 0)

    def scaled(vector: Column) -> Column:
        return let(
            norm(vector),
            lambda length: F.transform(
                vector,
                lambda x: F.when(length > 0, x / length).otherwise(F.lit(0.0)).cast("float"),
            ),
        )

    buckets = F.transform(words, lambda w: word_bucket(w, dimension))
    return let(bucket_counts(buckets, dimension), scaled)
