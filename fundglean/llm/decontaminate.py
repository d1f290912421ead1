"""Benchmark decontamination by spaced seeds.

Words (A-Z in lower case, punctuation at their ends removed) of benchmark items
and of documents are hashed under two fixed masks that look at six of eight
positions. Any 13 words of which at most two are substituted agree under one of
the masks somewhere, so no such overlap is missed. Hash hits are joined, and around
each hit the words of both sides are compared without gaps: 13 neighbouring words
with at least 0.8 of them equal make the document contaminated. Items of 8 to 12
words must occur whole, with at least 0.8 of their words equal; their masks leave out
every choice of so many words, by blocks, so no such overlap is missed either. Items of
one to 7 words must occur unchanged; one mask looks at all their words. ``item_status``
says how each item is looked for.

Hits of one text that agree in their hash and in all words that are compared are one
hit, so a text of one repeated word has a few. A filter of fixed size (2**24 bits) over the benchmark's hashes keeps hits out of
the shuffle that cannot join; a large benchmark fills it and only lets more pass.

Edge cases: null or empty texts neither contaminate nor are contaminated; repeated
rows are judged alike; ids may be of any type; an item with a null id counts, though lists
cannot show it; an item without words is not looked for; an empty table on either side
gives no contamination. Only ``doc_id``, ``item_id``
and ``text`` are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundglean.llm.common import column, fresh, mixed, row_key, word_codes, words_of

MASKS = ("11101011", "11001111")
SPAN = 8
WINDOW = 13
ENOUGH = 11  # of 13 words: 0.8, rounded up
LEAD = WINDOW - SPAN  # how far before a hit a window may begin
CONTEXT = LEAD + WINDOW
FILTER_BITS = 24
FACTORS = np.array([2 * i + 1 for i in range(WINDOW)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
#: Blocks of a short item, one or two of which its masks leave out: as many as may differ.
BLOCKS = 4
PUNCTUATION = b".,;:!?\"'()[]{}*_-"


def codes_of(raw: bytes | None) -> np.ndarray:
    return word_codes([w.strip(PUNCTUATION) for w in words_of(raw)])


def enough(size: int) -> int:
    """How many of an item's neighbouring words must be equal: 0.8, rounded up, or all of a few."""
    return size if size < SPAN else -(-4 * min(size, WINDOW) // 5)


def short_masks(size: int) -> list[list[int]]:
    """Word offsets that each mask of an item of up to 12 words looks at.

    Each leaves out as many blocks of neighbouring words as words may differ, so that
    wherever these are, one mask does not look at them.
    """
    blocks = np.array_split(np.arange(size), BLOCKS)
    left_out = itertools.combinations(range(BLOCKS), size - enough(size))
    return [[int(i) for b in range(BLOCKS) if b not in out for i in blocks[b]] for out in left_out]


def short_kinds(size: int) -> list[int]:
    """Kinds of the masks of a short item: its size and the mask's number."""
    return [size * 16 + i for i in range(len(short_masks(size)))]


def seed_hashes(codes: np.ndarray, kind: int) -> np.ndarray:
    """Hashes at every position: kinds 0 and 1 are masks of windows, others of short items."""
    if kind < 2:
        offsets = [i for i, c in enumerate(MASKS[kind]) if c == "1"]
    else:
        offsets = short_masks(kind // 16)[kind % 16]
    n = len(codes) - (SPAN if kind < 2 else kind // 16) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, kind + 1, np.uint64)
    for i in offsets:
        total += codes[i : i + n] * FACTORS[i]
    return mixed(total)


def context(codes: np.ndarray, at: np.ndarray, outside: int) -> np.ndarray:
    """Rows of ``CONTEXT`` codes around the positions; ``outside`` stands beyond the ends."""
    ends = np.full(LEAD, outside, np.uint64), np.full(WINDOW, outside, np.uint64)
    padded = np.concatenate([ends[0], codes, ends[1]])
    return padded[at[:, None] + np.arange(CONTEXT)]


WEIGHTS = np.array([2 * i + 1 for i in range(CONTEXT)], np.uint64) * np.uint64(0xD1342543DE82EF95)


def told_apart(hashes: np.ndarray, around: np.ndarray, kind: int) -> np.ndarray:
    """Places of hits without those that would be compared just like one before."""
    compared = slice(0, CONTEXT) if kind < 2 else slice(LEAD, LEAD + kind // 16)
    total = (around[:, compared] * WEIGHTS[compared]).sum(axis=1, dtype=np.uint64)
    return np.sort(np.unique(mixed(total) + hashes, return_index=True)[1])


class Hits:
    """Hits of several texts, each named by a value, as Arrow columns."""

    def __init__(self, name: str, kind: pa.DataType) -> None:
        self._name, self._type = name, kind
        self._values: list = []
        self._found: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, value: object, kind: int, hashes: np.ndarray, at: np.ndarray, around: np.ndarray) -> None:
        own = told_apart(hashes, around, kind)
        self._values.append(value)
        self._found.append((kind, hashes[own], at[own], around[own]))
        self.size += len(own)

    def batch(self) -> pa.RecordBatch:
        sizes = [len(f[2]) for f in self._found]
        kinds, hashes, at, around = zip(*self._found, strict=True) if self._found else ((), (), (), ())

        def joined(parts: tuple, kind: type) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *[p.astype(kind) for p in parts]])

        flat = joined(tuple(x.reshape(-1) for x in around), np.uint64).view(np.int64)
        offsets = np.arange(sum(sizes) + 1, dtype=np.int32) * CONTEXT
        return pa.RecordBatch.from_arrays(
            [
                pa.array([v for v, n in zip(self._values, sizes, strict=True) for _ in range(n)], self._type),
                pa.array(np.repeat(np.array(kinds, np.int32), sizes) if sizes else np.zeros(0, np.int32)),
                pa.array(joined(hashes, np.uint64).view(np.int64)),
                pa.array(joined(at, np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            ],
            [self._name, "kind", "hash", "at", "around"],
        )


HIT_SCHEMA = "kind int, hash long, at long, around array<long>"


def item_seeds(benchmark: DataFrame) -> DataFrame:
    """All seeds of the benchmark's items, with the words around them."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Hits("item_id", batch.column(0).type)
            for item, raw in zip(batch.column(0).to_pylist(), column(batch, 1), strict=True):
                codes = codes_of(raw)
                if len(codes) == 0:
                    continue
                for kind in (0, 1) if len(codes) >= WINDOW else short_kinds(len(codes)):
                    hashes = seed_hashes(codes, kind)
                    at = np.arange(len(hashes))
                    found.add(item, kind, hashes, at, context(codes, at, 1))
            yield found.batch()

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.select("item_id", "text").mapInArrow(seeds, f"item_id {kind}, {HIT_SCHEMA}")


def item_status(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``n_words`` and ``status``: looked for by ``windows``, ``whole``, or ``unchanged``.

    Items without words are ``empty``, and not looked for.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(words_of(raw)) for raw in column(batch, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32())], ["item_id", "n_words"]
            )

    n = F.col("n_words")
    status = (
        F.when(n == 0, "empty").when(n < SPAN, "unchanged").when(n < WINDOW, "whole").otherwise("windows")
    )
    kind = benchmark.schema["item_id"].dataType.simpleString()
    rows = benchmark.select("item_id", "text").mapInArrow(counted, f"item_id {kind}, n_words int")
    return rows.withColumn("status", status)


def filter_of(seeds: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The bit filter over the seeds' hashes (2 MB), and the kinds that occur."""
    bit = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    words = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    packed = (
        seeds.groupBy(F.shiftright(bit, 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - FILTER_BITS}) & 63 AS int))")))
        .collect()
    )
    for word, bits in packed:
        words[word] = bits & 0xFFFFFFFFFFFFFFFF
    kinds = sorted(r[0] for r in seeds.select("kind").distinct().collect())
    return words, kinds


def document_hits(docs: DataFrame, words: np.ndarray, kinds: list[int]) -> DataFrame:
    """Seeds of all documents' texts that pass the filter."""

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Hits("row_key", pa.binary())
            for key, raw in zip(column(batch, 0), column(batch, 1), strict=True):
                codes = codes_of(raw)
                for kind in kinds:
                    hashes = seed_hashes(codes, kind)
                    bit = hashes >> np.uint64(64 - FILTER_BITS)
                    on = words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))
                    at = np.flatnonzero(on & np.uint64(1))
                    if len(at):
                        found.add(key, kind, hashes[at], at, context(codes, at, 0))
                if found.size > 20_000:
                    yield found.batch()
                    found = Hits("row_key", pa.binary())
            yield found.batch()

    rows = docs.select(row_key("doc_id", "text").alias("row_key"), F.col("text"))
    return rows.mapInArrow(hits, f"row_key binary, {HIT_SCHEMA}")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified hits: ``row_key`` of the document, ``item_id``, positions, equal words."""
    seeds = item_seeds(benchmark)
    words, kinds = filter_of(seeds)
    d = document_hits(docs, words, kinds)
    b = seeds.select(
        "item_id", "kind", "hash", F.col("at").alias("item_at"),
        F.col("around").alias("item_around"),
    )
    same = F.zip_with("around", "item_around", lambda x, y: (x == y).cast("int"))
    joined = d.join(b, ["kind", "hash"]).withColumn("same", same)
    count = "aggregate(slice(same, {first}, {n}), 0, (a, x) -> a + x)"
    best = F.greatest(*[F.expr(count.format(first=i + 1, n=WINDOW)) for i in range(LEAD + 1)])
    size = F.shiftright("kind", 4)
    whole = F.expr(count.format(first=LEAD + 1, n="shiftright(kind, 4)"))
    equal = F.when(F.col("kind") < 2, best).otherwise(whole)
    needed = F.when(F.col("kind") < 2, ENOUGH).when(size < SPAN, size).otherwise(F.ceil(4 * size / 5))
    return (
        joined.withColumn("equal", equal)
        .where(F.col("equal") >= needed)
        .select("row_key", "item_id", "at", "item_at", "equal")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document text: ``row_key``, seeds found, ids of the items."""
    return (
        overlaps(docs, benchmark)
        .groupBy("row_key", "item_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("row_key")
        .agg(F.sum("n").alias("n_hits"), F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``contaminated``, ``n_hits`` and ``item_ids`` for every document."""
    found = contaminated(docs, benchmark)
    ids = found.schema["item_ids"].dataType.simpleString()
    keyed = docs.select("doc_id", row_key("doc_id", "text").alias("row_key"))
    return keyed.join(found, "row_key", "left").select(
        "doc_id",
        F.col("n_hits").isNotNull().alias("contaminated"),
        F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"),
        F.coalesce("item_ids", F.array().cast(ids)).alias("item_ids"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that share no overlap with the benchmark, all columns kept."""
    key = fresh(docs, "row_key")
    found = contaminated(docs, benchmark).select(F.col("row_key").alias(key))
    return docs.withColumn(key, row_key("doc_id", "text")).join(found, key, "left_anti").drop(key)
