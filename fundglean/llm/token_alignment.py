"""Alignment of two tokenizers' ids of the same texts, counted over the corpus.

Tokens of both cover the same bytes. In Arrow tables, a slice of documents at a time: lists
of ids are flattened with the indices of their documents; the byte lengths of the ids are
summed up and taken back to each document's start, which gives every token its end; a
full outer Acero join on (document, end) keys brings both sides' ends together. Between two
neighbouring ends of either side lies a piece of exactly one token of each, so the joined
rows in order, with ids filled in from the next row that has one, are the links: all
pairs of tokens that overlap, each once. Ends that both sides have cut the text into
groups. Links are counted by document and id pair with ``Table.group_by``, and over the
slice; Spark adds the slices' counts up, finds the most frequent partners of each id, and
brings both back to the documents. Pair counts that may be broadcast are bounded in
number, the other pairs meet the documents' pairs in a join.

Edge cases: a text that is null or empty, or that a tokenizer does not give back byte by
byte, has no tokens; the strings of special tokens are plain text; repeated rows are
aligned and counted each; an empty table gives no rows; columns other than ``doc_id`` and
``text`` play no part.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundglean.llm.common import checkpoint, shared_folder
from fundglean.llm.tokenizing import (
    bpe_bytes,
    bpe_pieces,
    byte_entries,
    piece_entries,
    public_path,
    slices,
)

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE_BYTES = 2_000_000
FREQUENT = 1 << 19  # pairs whose counts may be broadcast, 17 bytes each
DOC, COUNT = "doc", "count"  # kinds of the rows written


def gives_back(ids: pa.ListArray, entries: pa.Array, texts: list[bytes]) -> np.ndarray:
    """For each document, whether its ids' entries join to exactly its text."""
    joined = pc.take(entries, pc.list_flatten(ids))
    offsets = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, 8 * joined.offset)
    at = offsets[np.asarray(ids.offsets)]
    raw = memoryview(joined.buffers()[2] or b"").cast("B")
    return np.array([raw[at[k] : at[k + 1]] == text for k, text in enumerate(texts)], bool)


def emptied(ids: pa.ListArray, kept: np.ndarray) -> pa.ListArray:
    """The lists, those not kept without any ids."""
    if kept.all():
        return ids
    lists = pc.if_else(pa.array(kept), ids, pa.scalar([], ids.type))
    return pa.ListArray.from_arrays(lists.offsets, lists.values)


def ends(ids: pa.ListArray, lengths: pa.Array, starts: pa.Array, name: str) -> pa.Table:
    """The tokens in order: ``key``, made of the document's index and the token's end, and the id."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
    upto = pc.cumulative_sum(pc.take(lengths, flat))
    end = pc.subtract(upto, pc.take(starts, parent))
    key = pc.add(pc.shift_left(parent.cast(pa.int64()), pa.scalar(32, pa.int64())), end)
    return pa.table({"key": key, name: flat})


def group_texts(ids: pa.Array, closes: pa.Array) -> pa.Array:
    """Ids joined by commas, up to each token that closes a group."""
    offsets = np.concatenate(([0], np.flatnonzero(np.asarray(closes)) + 1))
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids.cast(pa.string()))
    return pc.binary_join(lists, ",")


def summed(table: pa.Table, by: list[str], column: str, how: str, n: int) -> np.ndarray:
    """A number for each of ``n`` documents, 0 where the table has none."""
    found = table.group_by(by, use_threads=False).aggregate([(column, how)])
    out = np.zeros(n, np.int64)
    out[np.asarray(found.column(by[0]))] = np.asarray(found.column(f"{column}_{how}"))
    return out


def aligned(
    a_ids: pa.ListArray, b_ids: pa.ListArray, a_lengths: pa.Array, b_lengths: pa.Array, n_bytes: np.ndarray
) -> tuple[dict[str, list], pa.Table]:
    """Columns of the documents, and ``doc``, ``pair``, ``n`` of their linked id pairs.

    Each document's ids of both sides cover its ``n_bytes``. A pair is written as a's id times
    the number of b's ids, plus b's id.
    """
    n = len(a_ids)
    starts = pa.array(np.cumsum(n_bytes) - n_bytes)
    joined = ends(a_ids, a_lengths, starts, "a").join(
        ends(b_ids, b_lengths, starts, "b"), "key", join_type="full outer", use_threads=False
    )
    joined = joined.take(pc.sort_indices(joined.column("key"))).combine_chunks()
    key, a, b = (joined.column(c) for c in ("key", "a", "b"))
    if joined.num_rows:
        key, a, b = key.chunk(0), a.chunk(0), b.chunk(0)
    else:
        key, a, b = pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.int32())
    doc = pc.shift_right(key, pa.scalar(32, pa.int64()))
    both = pc.and_(a.is_valid(), b.is_valid())
    groups = pc.binary_join_element_wise(
        group_texts(a.drop_null(), both.filter(a.is_valid())),
        group_texts(b.drop_null(), both.filter(b.is_valid())),
        "|",
    )
    pair = pc.add(
        pc.multiply(pc.fill_null_backward(a).cast(pa.int64()), pa.scalar(len(b_lengths), pa.int64())),
        pc.fill_null_backward(b).cast(pa.int64()),
    )
    links = pa.table({"doc": doc, "pair": pair})
    pairs = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    pairs = pairs.rename_columns(["doc", "pair", "n"])
    closing = pa.table({"doc": doc, "both": both.cast(pa.int64())})
    n_groups = summed(closing, ["doc"], "both", "sum", n)
    offsets = pa.array(np.concatenate(([0], np.cumsum(n_groups))), pa.int32())
    said = pc.binary_join(pa.ListArray.from_arrays(offsets, groups), ";").to_pylist()
    columns = {
        "n_a": np.diff(np.asarray(a_ids.offsets)),
        "n_b": np.diff(np.asarray(b_ids.offsets)),
        "n_groups": n_groups,
        "n_links": summed(pairs, ["doc"], "n", "sum", n),
        "groups_sha256": [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said],
    }
    return columns, pairs


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def written(docs: DataFrame, a_path: str, b_path: str, folder: str) -> None:
    """Write a row for each document and one for each slice, with their id pairs and counts."""
    kind_of_id = docs.schema["doc_id"].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = bpe_bytes(a_path), bpe_pieces(b_path)
        entries = [
            pa.array(e, pa.large_binary()) for e in (byte_entries(a_path), piece_entries(b_path))
        ]
        lengths = [pc.binary_length(e).cast(pa.int64()) for e in entries]
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for some in slices(batch.column(1), SLICE_BYTES):
                texts = pc.fill_null(batch.column(1)[some.start : some.stop], "")
                raw = [(" " + t).encode() if t else b"" for t in texts.to_pylist()]
                found = [encode(texts) for encode in encoders]
                same = np.array([bool(r) for r in raw])
                for ids, entry in zip(found, entries, strict=True):
                    same &= gives_back(ids, entry, raw)
                sizes = np.array([len(r) for r in raw]) * same
                a_ids, b_ids = (emptied(ids, same) for ids in found)
                columns, pairs = aligned(a_ids, b_ids, *lengths, sizes)
                yield from rows(row, batch.column(0)[some.start : some.stop], columns, pairs)
                row += len(texts)

    def rows(row: int, doc_ids: pa.Array, columns: dict, pairs: pa.Table) -> Iterator[pa.RecordBatch]:
        n = len(doc_ids)
        ordered = pairs.sort_by("doc")
        cuts = np.searchsorted(np.asarray(ordered.column("doc")), np.arange(n + 1))
        slice_counts = pairs.group_by("pair", use_threads=False).aggregate([("n", "sum")])
        names = ["kind", "row", "doc_id", *NUMBERS, "groups_sha256", "pairs", "counts"]

        def lists(offsets: np.ndarray, table: pa.Table, counts: str) -> list[pa.Array]:
            offsets = pa.array(offsets, pa.int32())
            flat = [table.column(c).combine_chunks().cast(pa.int64()) for c in ("pair", counts)]
            flat = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in flat]
            return [pa.ListArray.from_arrays(offsets, x) for x in flat]

        yield pa.RecordBatch.from_arrays(
            [
                pa.array([DOC] * n),
                pa.array(np.arange(row, row + n)),
                doc_ids,
                *[pa.array(columns[c], pa.int64()) for c in NUMBERS],
                pa.array(columns["groups_sha256"], pa.string()),
                *lists(cuts, ordered, "n"),
            ],
            names,
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([COUNT]),
                *[pa.nulls(1, t) for t in (pa.int64(), doc_ids.type, *[pa.int64()] * 4, pa.string())],
                *lists(np.array([0, slice_counts.num_rows]), slice_counts, "n_sum"),
            ],
            names,
        )

    schema = (
        f"kind string, row long, doc_id {kind_of_id}, "
        + ", ".join(f"{c} long" for c in NUMBERS)
        + ", groups_sha256 string, pairs array<long>, counts array<long>"
    )
    found = docs.select("doc_id", "text").mapInArrow(align, schema)
    found.write.partitionBy("kind").option("compression", "zstd").parquet(folder)


def exploded(rows: DataFrame, *columns: str) -> DataFrame:
    zipped = F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("m"))
    return rows.select(*columns, F.inline(zipped))


def pair_counts(slices_: DataFrame, b_size: int) -> DataFrame:
    """``pair``, ``n`` links that hold it corpus-wide, ``best`` if that is the most of its b id."""
    counts = exploded(slices_).groupBy("pair").agg(F.sum("m").alias("n"))
    counts = checkpoint(counts.withColumn("b", F.col("pair") % b_size))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # a row for each of b's ids
    return counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def broadcast_from(counts: DataFrame, most: int) -> int:
    """The least count, a power of two, that at most ``most`` pairs have or exceed."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = dict(counts.groupBy(power.alias("power")).count().collect())  # 63 rows at most
    total, at = 0, max(sizes, default=0) + 1
    while at > 0 and total + sizes.get(at - 1, 0) <= most:
        at -= 1
        total += sizes.get(at, 0)
    return 1 << at


def corpus_links(documents: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``row``, ``n_best`` and ``count_sum`` of the documents that have links."""
    least = broadcast_from(counts, frequent)
    sums = [
        F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"),
        F.sum(F.col("m") * F.col("n")).alias("count_sum"),
    ]
    often = F.broadcast(counts.where(F.col("n") >= least))
    met = exploded(documents, "row").join(often, "pair", "left")
    found = met.where("n IS NOT NULL").groupBy("row").agg(*sums)
    if least > 1:
        rest = met.where("n IS NULL").select("row", "pair", "m").join(counts.where(F.col("n") < least), "pair")
        found = found.unionAll(rest.groupBy("row").agg(*sums))
    return found.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_documents(
    docs: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    frequent: int = FREQUENT,
    folder: str | None = None,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each document.

    The alignment itself stays in ``folder`` (by default one in the shared folder): rows of
    kind ``doc`` with the documents' id pairs, of kind ``count`` with those of slices.
    """
    spark = docs.sparkSession
    a_path, b_path = a_path or public_path(VOCABULARY_A), b_path or public_path(VOCABULARY_B)
    folder = folder or f"{shared_folder(spark)}/token-alignment-{uuid.uuid4().hex}"
    written(docs, a_path, b_path, folder)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = spark.read.schema(
        f"row long, doc_id {kind}, {', '.join(f'{c} long' for c in NUMBERS)}, groups_sha256 string, "
        "pairs array<long>, counts array<long>, kind string"
    ).parquet(folder)
    documents = rows.where(F.col("kind") == DOC)
    counts = checkpoint(pair_counts(rows.where(F.col("kind") == COUNT), len(piece_entries(b_path))))
    links = corpus_links(documents, counts, frequent)
    return documents.join(links, "row", "left").select(
        "doc_id",
        *NUMBERS,
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256",
    )
