"""Files of token ids, compressed by grammars (Re-Pair), with random access.

Documents in ascending order of id are encoded and written as shards of neighbouring
documents. In each shard the most frequent pairs of neighbouring symbols are replaced by
new symbols, round by round; pairs of one round do not overlap, as a symbol is either the
left or the right half of the round's pairs (or both of one pair of equals). A pair never
spans two documents. A round takes the better half of what new symbols are left.

A file is Parquet, a row for each shard: ``part`` and ``shard`` (their order is that of the
documents), ``doc_ids``, for each document ``doc_tokens`` and ``doc_symbols`` (numbers of ids
and of symbols), ``n_tokens``, ``first_rule`` (symbols under it are ids), and as
little-endian bytes ``rules`` (32-bit pairs), ``lengths`` (32-bit expansion lengths of the
rules) and ``symbols`` (16-bit, or 32-bit if ``first_rule`` does not leave room for rules).
A document, or a range of its ids, is decoded from its own symbols and the rules alone.

Edge cases: a null text is empty; every document has at least the end id; null ids sort
first; rows with the same id are ordered by a hash of the text, and equal rows are
documents of their own; an empty table gives files without rows; a text longer than a
shard is a shard of its own; other columns play no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from fundglean.llm.common import fresh, shared_folder
from fundglean.llm.tokenizing import Encoder, bpe_words, public_path, slices

VOCABULARY = "word_bpe_49k.json"
IDS = 49_408  # of that vocabulary; symbols from here on are rules
END = 1  # fixed value: ends each document
SHARD_TOKENS = 1 << 21
MIN_COUNT = 6  # fewer occurrences cost more than their rule saves
ROUND_GAIN = 0.03  # a round that shortens a shard by less is the last one
ROWS_SENT = 1_000_000  # shards whose places (24 bytes each) may be broadcast


class Grammar(NamedTuple):
    symbols: np.ndarray
    rules: np.ndarray  # pairs of symbols, made of ids and earlier rules
    lengths: np.ndarray  # ids that each rule stands for
    doc_symbols: np.ndarray


def symbol_type(first_rule: int) -> np.dtype:
    """16 bits where that leaves room for some thousand rules."""
    return np.dtype("<u2" if first_rule <= 60_000 else "<u4")


def chosen(keys: np.ndarray, shift: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent pairs that cannot overlap, best first: those of two symbols, and of equals."""
    ordered = np.sort(keys)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(starts, len(ordered)))
    often = np.flatnonzero(counts >= MIN_COUNT)
    best = often[np.argsort(-counts[often], kind="stable")[: 2 * most]]
    side: dict[int, int] = {}
    two, same = [], []
    for key in ordered[starts[best]].tolist():
        left, right = key >> shift, key & ((1 << shift) - 1)
        if len(two) + len(same) == most:
            break
        if left == right:
            if left not in side:
                side[left] = 3
                same.append(key)
        elif side.get(left, 1) == 1 and side.get(right, 2) == 2:
            side[left], side[right] = 1, 2
            two.append(key)
    return np.array(two, keys.dtype), np.array(same, keys.dtype)


def numbered(places: np.ndarray, keys: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose keys are among ``pairs``, and which of them each is."""
    order = np.argsort(pairs)
    ordered, found = pairs[order], keys[places]
    near = np.minimum(np.searchsorted(ordered, found), len(ordered) - 1)
    hit = ordered[near] == found
    return places[hit], order[near[hit]]


def compressed(ids: np.ndarray, doc_tokens: np.ndarray, first_rule: int = IDS) -> Grammar:
    """The grammar of the ids of neighbouring documents; every document has an id at least."""
    narrow = symbol_type(first_rule)
    shift, key_type = (16, np.uint32) if narrow.itemsize == 2 else (32, np.uint64)
    room = (1 << 16) - first_rule if narrow.itemsize == 2 else 1 << 20
    symbols = ids.astype(key_type)
    last = np.zeros(len(ids), bool)
    last[np.cumsum(doc_tokens) - 1] = True
    rules, next_rule = [], first_rule
    lengths = np.ones(first_rule, np.int64)
    while room > 0 and len(symbols) > 1:
        keys = (symbols[:-1] << key_type(shift)) | symbols[1:]
        inside = ~last[:-1]
        two, same = chosen(keys[inside], shift, max(256, room // 2))
        two, same = two[:room], same[: room - len(two[:room])]
        at, said = [], []
        if len(two):
            left, right = np.zeros(next_rule, bool), np.zeros(next_rule, bool)
            left[two >> key_type(shift)] = True
            right[two & key_type((1 << shift) - 1)] = True
            places = np.flatnonzero(left[symbols[:-1]] & right[symbols[1:]] & inside)
            places, number = numbered(places, keys, two)
            at.append(places)
            said.append(number + next_rule)
        if len(same):
            equal = (symbols[:-1] == symbols[1:]) & inside
            places = np.flatnonzero(equal)
            # every other place of a run of equals
            begins = np.flatnonzero(np.diff(places, prepend=-2) != 1)
            place = np.arange(len(places))
            run = place - np.repeat(begins, np.diff(np.append(begins, len(places))))
            places, number = numbered(places[run % 2 == 0], keys, same)
            at.append(places)
            said.append(number + next_rule + len(two))
        taken = sum(map(len, at))
        if taken == 0:
            break
        pairs = np.concatenate((two, same))
        halves = np.stack((pairs >> key_type(shift), pairs & key_type((1 << shift) - 1)), axis=1)
        rules.append(halves)
        lengths = np.concatenate((lengths, lengths[halves].sum(axis=1)))
        next_rule, room = next_rule + len(pairs), room - len(pairs)
        places = np.concatenate(at)
        symbols[places] = np.concatenate(said).astype(key_type)
        last[places] = last[places + 1]
        kept = np.ones(len(symbols), bool)
        kept[places + 1] = False
        before = len(symbols)
        symbols, last = symbols[kept], last[kept]
        if taken < ROUND_GAIN * before:
            break
    made = np.concatenate(rules).astype("<u4") if rules else np.zeros((0, 2), "<u4")
    ends = np.flatnonzero(last)
    return Grammar(
        symbols.astype(narrow), made, lengths[first_rule:].astype("<u4"), np.diff(ends, prepend=-1)
    )


class Decoder:
    """Ids of any symbols of a shard."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, first_rule: int) -> None:
        made = np.arange(first_rule, first_rule + len(rules), dtype=np.int64)
        while (nested := made >= first_rule).any():
            wider = np.repeat(made, 1 + nested)
            at = (np.cumsum(1 + nested) - 1 - nested)[nested]
            wider[at], wider[at + 1] = rules[made[nested] - first_rule].T
            made = wider
        ids = np.arange(first_rule, dtype=np.int64)
        self.expanded = np.concatenate((ids, made)).astype("<u4")
        self.sizes = np.concatenate((np.ones(first_rule, np.int64), lengths.astype(np.int64)))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def ids(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.sizes[symbols]
        upto = np.cumsum(sizes)
        shift = self.starts[symbols] - upto + sizes
        return self.expanded[np.repeat(shift, sizes) + np.arange(upto[-1] if len(upto) else 0)]

    def between(self, symbols: np.ndarray, first: int, end: int) -> np.ndarray:
        """Ids ``first`` to ``end`` (excluded), decoding the symbols that hold them only."""
        upto = np.cumsum(self.sizes[symbols])
        first, end = max(first, 0), min(end, int(upto[-1]) if len(upto) else 0)
        if first >= end:
            return np.zeros(0, "<u4")
        a, b = np.searchsorted(upto, [first, end - 1], side="right")
        before = int(upto[a] - self.sizes[symbols[a]])
        return self.ids(symbols[a : b + 1])[first - before : end - before]


def decoder_of(row: dict) -> Decoder:
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    return Decoder(rules, np.frombuffer(row["lengths"], "<u4"), row["first_rule"])


def symbols_of(row: dict) -> np.ndarray:
    return np.frombuffer(row["symbols"], symbol_type(row["first_rule"]))


def write(
    docs: DataFrame,
    folder: str,
    path: str | None = None,
    load: Callable[[str], Encoder] = bpe_words,
    first_rule: int = IDS,
    end: int = END,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode the documents with the tokenizer at ``path``, and write the shards to ``folder``.

    Documents are ordered by a range partitioning; a task writes the shards of its range.
    """
    path = path or public_path(VOCABULARY)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load(path)
        part, number, held, doc_ids, sizes, size = None, 0, [], [], [], 0

        def out() -> pa.RecordBatch:
            doc_tokens = np.concatenate(sizes)
            grammar = compressed(np.concatenate(held), doc_tokens, first_rule)
            row = {
                "part": part,
                "shard": number,
                "n_tokens": int(doc_tokens.sum()),
                "first_rule": first_rule,
                "doc_ids": [i for some in doc_ids for i in some.to_pylist()],
                "doc_tokens": doc_tokens,
                "doc_symbols": grammar.doc_symbols,
                "rules": grammar.rules.tobytes(),
                "lengths": grammar.lengths.tobytes(),
                "symbols": grammar.symbols.tobytes(),
            }
            return pa.RecordBatch.from_arrays(
                [pa.array([v], type_of.get(k)) for k, v in row.items()], list(row)
            )

        type_of = {
            "part": pa.int32(), "shard": pa.int32(), "n_tokens": pa.int64(), "first_rule": pa.int32(),
            "doc_tokens": pa.list_(pa.int64()), "doc_symbols": pa.list_(pa.int32()),
        }
        for batch in batches:
            if batch.num_rows == 0:
                continue
            type_of["doc_ids"] = pa.list_(batch.column(0).type)
            part = batch.column(2)[0].as_py()
            for some in slices(batch.column(1)):
                ids, texts = (batch.column(c)[some.start : some.stop] for c in (0, 1))
                found = encode(texts)
                upto = np.asarray(found.offsets).astype(np.int64)
                # the end id after each document
                tokens = np.insert(np.asarray(found.values), upto[1:], end)
                upto += np.arange(len(upto))
                first = 0
                while first < len(ids):
                    reached = np.searchsorted(upto, upto[first] + shard_tokens - size)
                    last = min(max(int(reached), first + 1), len(ids))
                    held.append(tokens[upto[first] : upto[last]])
                    doc_ids.append(ids[first:last])
                    sizes.append(np.diff(upto[first : last + 1]))
                    size += int(upto[last] - upto[first])
                    first = last
                    if size >= shard_tokens:
                        yield out()
                        number, held, doc_ids, sizes, size = number + 1, [], [], [], 0
        if held:
            yield out()

    tie = fresh(docs, "tie")
    order = ["doc_id", F.xxhash64("text"), tie]
    ordered = (
        docs.select("doc_id", "text", F.monotonically_increasing_id().alias(tie))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    schema = (
        f"part int, shard int, n_tokens long, first_rule int, doc_ids array<{kind}>, "
        "doc_tokens array<long>, doc_symbols array<int>, rules binary, lengths binary, symbols binary"
    )
    ordered.mapInArrow(shards, schema).write.parquet(folder)


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``part``, ``shard`` and ``start``, the number of ids in all shards before.

    Summed within each part, then over the parts, of which each task wrote one.
    """
    sizes = spark.read.parquet(folder).select("part", "shard", "n_tokens")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)

    def earlier(total: str, window: WindowSpec) -> Column:
        return F.coalesce(F.sum(total).over(window), F.lit(0))

    inside = before.partitionBy("part").orderBy("shard")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", earlier("n", before.orderBy("part")).alias("from"))
    placed = sizes.select("part", "shard", earlier("n_tokens", inside).alias("inside"))
    starts = placed.join(parts, "part").select(
        "part", "shard", (F.col("from") + F.col("inside")).alias("start")
    )
    return F.broadcast(starts) if sizes.count() <= ROWS_SENT else starts


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers.
    """
    shards = spark.read.parquet(folder).join(shard_starts(spark, folder), ["part", "shard"])
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("first_rule", "rules", "lengths", "symbols")}
                n = np.asarray(batch.column("doc_tokens")[i].values)
                ids = decoder_of(row).ids(symbols_of(row))
                upto = np.cumsum(n)
                offsets = pa.py_buffer(np.concatenate(([0], 4 * upto)).astype(np.int64))
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(n), [None, offsets, pa.py_buffer(ids)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[i].values,
                        pa.array(batch.column("start")[i].as_py() + upto - n),
                        pa.array(n),
                        raw.cast(pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    needed = ["start", "first_rule", "doc_ids", "doc_tokens", "rules", "lengths", "symbols"]
    schema = f"doc_id {kind}, start long, n_tokens long, ids binary"
    return shards.select(*needed).mapInArrow(documents, schema)


def read_ranges(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """``wanted`` (``doc_id``, ``first``, ``end``) with ``ids`` of these ranges of documents.

    Only shards that hold one of the documents are decoded, and of these only the symbols
    of the ranges. Documents that are not there are left out.
    """
    shards = spark.read.parquet(folder)
    index = shards.select("part", "shard", F.posexplode("doc_ids").alias("k", "doc_id"))
    asked = index.join(wanted.select("doc_id", "first", "end"), "doc_id")
    asked = asked.groupBy("part", "shard").agg(F.collect_list(F.struct("k", "doc_id", "first", "end")).alias("asked"))
    needed = ["first_rule", "rules", "lengths", "symbols", "doc_symbols", "asked"]
    met = shards.join(asked, ["part", "shard"]).select(*needed)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                decoder, symbols = decoder_of(row), symbols_of(row)
                upto = np.concatenate(([0], np.cumsum(row["doc_symbols"])))
                found = [
                    decoder.between(symbols[upto[a["k"]] : upto[a["k"] + 1]], a["first"], a["end"]).tobytes()
                    for a in row["asked"]
                ]
                names = ["doc_id", "first", "end"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[c] for a in row["asked"]]) for c in names] + [pa.array(found, pa.binary())],
                    [*names, "ids"],
                )

    return met.mapInArrow(ranges, f"doc_id {kind}, first long, end long, ids binary")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the documents' ids to the shared folder and read them back."""
    folder = f"{shared_folder(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    write(docs, folder, path)
    return read(docs.sparkSession, folder)
