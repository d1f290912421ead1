"""Near-duplicate groups by SimHash fingerprints and pigeonring filtering.

A fingerprint bit is set if it is set in over half of the 64-bit hashes of the
text's word shingles. Fingerprints link at ``max_bits`` or fewer differing bits
(3 at most). The 64 bits form a ring of eight segments; if two fingerprints link,
some segment starts a chain whose first l segments differ in at most
floor(l * max_bits / 8) bits, for every l. For three bits that means: the first two
segments are equal and at most one bit differs in the next three, so two of those
three are equal as well. Both together, 32 bits, are the key that brings candidates
together, in 24 ways; the chain's other budgets prune candidates before the full
Hamming check. Only different fingerprints are compared, and each bucket hands on
the links of a spanning forest of its members.

Links between fingerprints are closed to components by alternating large-star and
small-star rounds. Edge cases: a null or empty text has fingerprint zero, linked
like any other; a null id is passed over in the smallest id of a component (null
if all are); repeated rows share a component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundglean.llm.common import checkpoint, fresh, row_key, words_of

SEED = 42
SEGMENTS = 8
ONES = np.uint64(0x0101010101010101)
PIECE = 1 << 16
#: Which two of the third, fourth and fifth segment of a chain join its key.
PICKS = ((2, 3), (2, 4), (3, 4))
#: Pairs of a bucket compared at once.
BLOCK = 1 << 18


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """For each of the 64 bits, lowest first, how many hashes have it set."""
    total = np.zeros((8, 8), np.int64)  # bit within byte x byte
    for start in range(0, len(hashes), 255):
        part = hashes[start : start + 255]
        for bit in range(8):
            byte_sums = ((part >> np.uint64(bit)) & ONES).sum(dtype=np.uint64)
            total[bit] += np.frombuffer(byte_sums.tobytes(), np.uint8)
    return total.T.reshape(-1)


def fingerprint_of(raw: bytes | None, shingle: int) -> int:
    words = words_of(raw)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for start in range(0, n, PIECE):
        stop = min(n, start + PIECE)
        hashes = np.fromiter(
            (digest(b" ".join(words[i : i + shingle]), SEED) for i in range(start, stop)),
            np.uint64,
            stop - start,
        )
        total += bit_sums(hashes)
    bits = np.flatnonzero(2 * total > n)
    return sum(1 << int(i) for i in bits)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([signed(fingerprint_of(x, shingle)) for x in texts], dtype="int64")

    return prints.asNondeterministic()(text.cast("binary"))


def segments(x: np.ndarray) -> np.ndarray:
    return x.view(np.uint8).reshape(-1, 8)


def chain_holds(differing: np.ndarray, start: int, max_bits: int) -> np.ndarray:
    """Whether the chain from segment ``start`` stays within its proportional budgets."""
    ring = np.concatenate([differing, differing], axis=1)[:, start : start + SEGMENTS]
    budget = np.arange(1, SEGMENTS + 1) * max_bits // SEGMENTS
    return (np.cumsum(ring, axis=1, dtype=np.uint8) <= budget).all(axis=1)


def survivors(differing: np.ndarray, start: int, max_bits: int) -> np.ndarray:
    """Which of the pairs, given by their differing bits, keep the chain's budgets.

    The ring is turned to the chain's start; segment by segment, pairs over the budget so
    far go, and only the rest is looked at further. The last budget, the full distance,
    is left to the check that follows.
    """
    turn = np.uint64(8 * start)
    ring = differing if start == 0 else (differing >> turn) | (differing << (np.uint64(64) - turn))
    alive = np.arange(len(ring))
    spent = np.zeros(len(ring), np.uint8)
    for i in range(SEGMENTS - 1):
        spent += np.bitwise_count((ring[alive] >> np.uint64(8 * i)).astype(np.uint8))
        kept = spent <= (i + 1) * max_bits // SEGMENTS
        if not kept.all():
            alive, spent = alive[kept], spent[kept]
    return alive


def forest(members: np.ndarray, start: int, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the members of one bucket that link in this chain."""
    n = len(members)
    tree = np.arange(n)
    links = []
    rows = max(1, BLOCK // n)
    values = members.view(np.uint64)
    for first in range(0, n, rows):
        block = values[first : first + rows]
        differing = (block[:, None] ^ values[None, :]).reshape(-1)
        near = np.zeros(len(differing), bool)
        candidates = survivors(differing, start, max_bits)
        near[candidates] = np.bitwise_count(differing[candidates]) <= max_bits
        for i, row in enumerate(near.reshape(-1, n), first):
            others = i + 1 + np.flatnonzero(row[i + 1 :])
            others = others[tree[others] != tree[i]]
            if len(others):
                roots, at = np.unique(tree[others], return_index=True)
                links.extend((i, int(j)) for j in others[at])
                tree[np.isin(tree, roots)] = tree[i]
    return links


def links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints (``fingerprint``, distinct) in reach."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            parts = segments(x).astype(np.int64)
            for start in range(SEGMENTS):
                for way, pick in enumerate(PICKS):
                    chosen = [(start + i) % SEGMENTS for i in (0, 1, *pick)]
                    key = np.full(len(x), start * len(PICKS) + way, np.int64)
                    for i in chosen:
                        key = key << 8 | parts[:, i]
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(x)], ["key", "x"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_key, rest = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def linked(keys: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero(np.diff(keys)) + 1
            starts = np.concatenate([[0], edges, [len(keys)]])
            a, b = [], []
            for i in np.flatnonzero(np.diff(starts) > 1):
                members = x[starts[i] : starts[i + 1]]
                way = int(keys[starts[i]] >> 32) // len(PICKS)
                for one, two in forest(members, way, max_bits):
                    a.append(int(members[one]))
                    b.append(int(members[two]))
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

        for batch in batches:
            if not len(batch):
                continue
            keys = np.concatenate([rest_key, batch.column(0).to_numpy(zero_copy_only=False)])
            x = np.concatenate([rest, batch.column(1).to_numpy(zero_copy_only=False)])
            cut = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
            if cut:
                yield linked(keys[:cut], x[:cut])
            rest_key, rest = keys[cut:], x[cut:]
        if len(rest):
            yield linked(rest_key, rest)

    buckets = prints.select("fingerprint").mapInArrow(keyed, "key long, x long")
    return (
        buckets.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(compared, "a long, b long")
    )


def components(pairs: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the links; root is the component's smallest node."""

    def both(df: DataFrame) -> DataFrame:
        return df.unionAll(df.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def starred(df: DataFrame, small: bool) -> DataFrame:
        """Link each node's larger (or, if small, smaller) neighbours to its smallest one."""
        near = df if small else both(df)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        kept = near.join(least, "a")
        if small:
            moved = kept.select("b", "m").unionAll(least.select(F.col("a").alias("b"), "m"))
        else:
            moved = kept.where("b > a").select("b", "m")
        return moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    def downward(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    def digest(df: DataFrame) -> tuple:
        # sums of hashes tell two sets of links apart, whatever their order
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = checkpoint(downward(pairs.where("a <> b")).distinct())
    seen = digest(now)
    while True:
        now = checkpoint(starred(starred(now, small=False), small=True))
        state = digest(now)
        if state == seen:
            break
        seen = state
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def labelled(printed: DataFrame, max_bits: int) -> DataFrame:
    """``fingerprint`` and the ``root`` fingerprint of its component, for every fingerprint."""
    classes = printed.select("fingerprint").distinct()
    roots = components(links(classes, max_bits))
    joined = classes.join(roots, classes["fingerprint"] == roots["node"], "left")
    return joined.select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id`` of every document."""
    printed = checkpoint(
        docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fingerprint"))
    )
    smallest = printed.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    named = checkpoint(labelled(printed, max_bits).join(smallest, "fingerprint"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(least, "root").select("fingerprint", "component_id")
    return printed.join(labels, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The documents, all columns kept, with one row left of each component.

    It is a row with the smallest id (a null id comes last); of several such rows the
    one whose columns have the smallest hash, and one of equal rows.
    """
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind]
    key = fresh(docs, "row_key")
    keyed = docs.withColumn(key, row_key(*hashed))
    printed = checkpoint(
        keyed.select(
            F.struct(F.isnull("doc_id").alias("none"), "doc_id", F.col(key).alias("key")).alias("row"),
            fingerprint(F.col("text"), shingle).alias("fingerprint"),
        )
    )
    first = printed.groupBy("fingerprint").agg(F.min("row").alias("row"))
    chosen = (
        first.join(labelled(printed, max_bits), "fingerprint")
        .groupBy("root")
        .agg(F.min("row").alias("row"))
        .select(F.col("row.key").alias(key))
    )
    return keyed.join(chosen, key, "left_semi").dropDuplicates([key]).drop(key)
