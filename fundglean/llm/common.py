"""What several operators share: table reading, keys, words and checkpoints."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    A session without that setting, as in tests, gets a folder of its own if it is
    a local one; on a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get(CHECKPOINT_CONF)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError(f"set {CHECKPOINT_CONF} to a shared folder")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder, and read it from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(*columns: str) -> Column:
    """16 bytes for the given columns, nulls included; equal rows have equal keys.

    Two 64-bit hashes of different seeds, so that different rows do not share a key.
    """
    parts = [F.struct(F.isnull(F.col(c)), F.col(c)) for c in columns]
    hashes = [F.lpad(F.hex(F.xxhash64(F.lit(seed), *parts)), 16, "0") for seed in (1, 2)]
    return F.unhex(F.concat(*hashes))


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def words_of(raw: bytes | None) -> list[bytes]:
    """Words apart from ASCII white space, A-Z in lower case."""
    return raw.lower().split() if raw else []


def word_codes(words: list[bytes]) -> np.ndarray:
    """A 64-bit code for each word, the same in every process."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different tokens, the number of each token among them, and how many each text has.

    Tokens are those of ``words_of`` and one end, which is empty. ``texts`` are strings or null.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    found = lists.flatten().dictionary_encode()
    words, ids = found.dictionary, found.indices.to_numpy()
    offsets = lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    # What stands before the first white space and after the last may be empty: no word.
    filled = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not filled.all():
        stays = filled[ids]
        offsets = np.concatenate([[0], np.cumsum(stays)])[offsets]
        ids = ids[stays]
    sizes = np.diff(offsets) + 1
    every = np.full(len(ids) + len(texts), len(words), np.int64)
    is_word = np.ones(len(every), bool)
    is_word[np.cumsum(sizes) - 1] = False
    every[is_word] = ids
    return pa.concat_arrays([words.cast(pa.binary()), pa.array([b""])]), every, sizes


def plain(values: pa.Array) -> list:
    """The values as a list, by way of an array of objects, which is several times faster."""
    return values.to_numpy(zero_copy_only=False).tolist()


def text_groups(batch: pa.RecordBatch, i: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices with about ``limit`` bytes of texts (column ``i``), or one longer text, each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False) + 1, dtype=np.int64)
    first = 0
    while first < len(batch):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def column(batch: pa.RecordBatch, i: int) -> list:
    """The values of column ``i``; texts as bytes."""
    values = batch.column(i)
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        values = values.cast(pa.large_binary())
    return values.to_pylist()


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each uint64 stirred (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
