"""Exact vector search: per filing, the k nearest (phrase, chunk) pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundglean.operators.filters import with_tag
from fundglean.schemas import FILING_KEYS

DEFAULT_DEPTH = 1000
PHRASES_PER_BLOCK = 1024  # columns of one matrix product
CHUNKS_PER_PRODUCT = 1024  # its rows
SHIPPED_BYTES = 64_000_000  # phrase vectors sent to every task at most
HELD_BYTES = 64_000_000  # chunk vectors that a task holds while phrases stream by
RUN = 64  # neighbouring chunks that go to a part together, as a filing's mostly are
PENDING_PAIRS = 200_000  # pairs taken at least before they are cut to the nearest of each filing
SCORED_VALUES = 1 << 22  # numbers of vectors gathered at once to score single pairs
RANK_DIGITS = 12  # distances equal in exact arithmetic must tie
SLACK = 10.0 ** (1 - RANK_DIGITS)  # distances this near may have equal ranks


# What is kept of one chunk: its nearest phrases as parallel arrays.
NEAREST_TYPE = "phrase array<string>, rank_distance array<double>, distance array<double>"


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a list column with where each row's begin, and how many it has (0 if NULL)."""
    offsets = np.asarray(column.offsets, dtype=np.int64)
    sizes = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
    values = np.asarray(column.values.to_numpy(zero_copy_only=False), dtype=np.float64)
    return values, offsets[:-1], sizes


def _matrices(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors: the rows that have it, and their vectors as a matrix."""
    values, starts, sizes = _vectors(column)
    found = {}
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        found[int(size)] = rows, values[starts[rows][:, None] + np.arange(size)]
    return found


def _single(matrix: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Vectors at length one in single precision; NaN for those without a length."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return (matrix / norms[:, None]).astype(np.float32)


def _nearest(names: list[str | None], asked: dict[int, tuple[np.ndarray, np.ndarray]], depth: int):
    """Arrow function: vectors -> their ``depth`` nearest of the phrases given in order.

    Chunks and phrases meet by length, in matrix products of bounded size; what
    is nearest so far stands before the next block, so the stable sort breaks
    ties by phrase. A vector that is NULL, holds a NULL, or is all zeros has no
    distance to anything, and neither have vectors of different lengths.
    """

    def merged(vectors: np.ndarray, at: np.ndarray, matrix: np.ndarray, block: int):
        sizes = np.linalg.norm(vectors, axis=1)[:, None]
        best = None
        for first in range(0, len(at), block):
            part = matrix[first : first + block]
            with np.errstate(divide="ignore", invalid="ignore"):
                distance = 1 - vectors @ part.T / (sizes * np.linalg.norm(part, axis=1)[None, :])
            here = np.broadcast_to(at[first : first + block], distance.shape)
            rank = np.round(distance, RANK_DIGITS) + 0.0  # no negative zero
            if best is not None:
                rank, distance, here = (
                    np.concatenate(x, axis=1) for x in zip(best, (rank, distance, here))
                )
            order = np.argsort(rank, axis=1, kind="stable")[:, :depth]  # NaN goes last
            best = [np.take_along_axis(x, order, axis=1) for x in (rank, distance, here)]
        return best

    @F.arrow_udf(NEAREST_TYPE)
    def nearest(embedding: pa.Array) -> pa.Array:
        lists: list[tuple] = [((), (), ())] * len(embedding)
        for size, (rows, vectors) in _matrices(embedding).items():
            if size not in asked:
                continue
            at, matrix = asked[size]
            for first in range(0, len(rows), CHUNKS_PER_PRODUCT):
                some = slice(first, first + CHUNKS_PER_PRODUCT)
                rank, distance, here = merged(vectors[some], at, matrix, PHRASES_PER_BLOCK)
                kept = (~np.isnan(rank)).sum(axis=1)
                for i, row in enumerate(rows[some]):
                    n = kept[i]
                    lists[row] = here[i, :n], rank[i, :n], distance[i, :n]
        counts = [len(x[0]) for x in lists]
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
        flat = [np.concatenate([np.zeros(0), *(x[k] for x in lists)]) for k in range(3)]
        said = pa.array([names[int(i)] for i in flat[0]], pa.string())
        columns = [
            pa.ListArray.from_arrays(offsets, values)
            for values in (said, pa.array(flat[1]), pa.array(flat[2]))
        ]
        return pa.StructArray.from_arrays(columns, names=["phrase", "rank_distance", "distance"])

    return nearest


class _Held:
    """Chunks of one salt, and the nearest pairs of each of their filings so far.

    Products in single precision tell which pairs can be near enough; only these are scored
    in double precision, and no near pair is passed over.
    """

    def __init__(self, depth: int) -> None:
        self.depth = depth
        self.keys: list[tuple] = []
        self.numbers: list[int] = []
        self._columns: list[pa.Array] = []
        self._matrices: dict | None = None
        self._names: dict[int, str | None] = {}
        self._met = 0
        self._pending: list[tuple[np.ndarray, ...]] = []
        self._size = 0
        self._room = PENDING_PAIRS

    def add(self, batch: pa.RecordBatch) -> None:
        keys = (batch.column(c).to_pylist() for c in FILING_KEYS)
        self.keys += zip(*keys, strict=True)
        self.numbers += batch.column("chunk_num").to_pylist()
        self._columns.append(batch.column("vector"))

    def _prepare(self) -> None:
        column = pa.concat_arrays(self._columns)
        self._columns = []
        self._matrices = {}
        for size, (rows, matrix) in _matrices(column).items():
            norms = np.linalg.norm(matrix, axis=1)
            self._matrices[size] = rows, matrix, norms, _single(matrix, norms)
        place: dict[tuple, int] = {}
        self._filing = np.array([place.setdefault(k, len(place)) for k in self.keys])
        self._number = np.array([-1 if n is None else n for n in self.numbers], np.int64)
        # How far the last pair kept of each filing is, and its chunk number.
        self._limit = np.full(len(place), np.inf)
        self._last = np.full(len(place), np.iinfo(np.int64).max)

    def meet(self, batch: pa.RecordBatch) -> None:
        """Score the held chunks against phrases, which come in order of their names."""
        if self._matrices is None:
            self._prepare()
        names = batch.column("phrase").to_pylist()
        for size, (at, phrases) in _matrices(batch.column("vector")).items():
            if size not in self._matrices:
                continue
            held = self._matrices[size]
            for j in range(0, len(at), PHRASES_PER_BLOCK):
                part = phrases[j : j + PHRASES_PER_BLOCK]
                lengths = np.linalg.norm(part, axis=1)
                asked = at[j : j + PHRASES_PER_BLOCK], part, lengths, _single(part, lengths)
                for i in range(0, len(held[0]), CHUNKS_PER_PRODUCT):
                    self._take(tuple(x[i : i + CHUNKS_PER_PRODUCT] for x in held), asked, names)
        self._met += len(names)

    def _take(self, held: tuple[np.ndarray, ...], asked: tuple[np.ndarray, ...], names: list[str | None]) -> None:
        """Keep the pairs of some chunks and phrases that are not beyond their filing's limit."""
        (rows, chunks, norms, own), (at, phrases, lengths, theirs) = held, asked
        filing = self._filing[rows]
        # Twice what rounding can make of a product of unit vectors.
        error = (chunks.shape[1] + 8) * 2.0**-23
        with np.errstate(invalid="ignore"):
            likeness = own @ theirs.T
        least = 1 - self._limit[filing] - SLACK - error
        near = likeness >= least.astype(np.float32)[:, None]  # never so for NaN
        if likeness.shape[1] > self.depth and near.sum() > 4 * self.depth * len(rows):
            known = np.where(np.isnan(likeness), -np.inf, likeness)
            far = likeness.shape[1] - self.depth
            last = np.partition(known, far, axis=1)[:, far] - (SLACK + 2 * error)
            near &= likeness >= last.astype(np.float32)[:, None]
        found = np.flatnonzero(near)
        step = max(1, SCORED_VALUES // chunks.shape[1])
        for first in range(0, len(found), step):
            i, j = np.divmod(found[first : first + step], near.shape[1])
            with np.errstate(divide="ignore", invalid="ignore"):
                distance = 1 - np.einsum("ij,ij->i", chunks[i], phrases[j]) / (norms[i] * lengths[j])
            rank = np.round(distance, RANK_DIGITS) + 0.0  # no negative zero
            limit, row = self._limit[filing[i]], rows[i]
            # Of equal pairs the first by chunk number stay, then those met before.
            kept = (rank < limit) | ((rank == limit) & (self._number[row] < self._last[filing[i]]))
            if not kept.any():
                continue
            phrase = at[j[kept]]
            self._names.update((self._met + p, names[p]) for p in np.unique(phrase).tolist())
            self._pending.append((row[kept], phrase + self._met, distance[kept], rank[kept]))
            self._size += len(phrase)
            if self._size > self._room:
                self._cut()

    def _cut(self) -> tuple[np.ndarray, ...]:
        """Keep the nearest pairs of each filing, and note how far the last one is."""
        row, phrase, distance, rank = (np.concatenate(x) for x in zip(*self._pending, strict=True))
        filing = self._filing[row]
        order = np.lexsort((phrase, self._number[row], rank, filing))
        sorted_filing = filing[order]
        first = np.searchsorted(sorted_filing, sorted_filing)
        place = np.arange(len(order)) - first
        last = order[place == self.depth - 1]
        self._limit[filing[last]] = rank[last]
        self._last[filing[last]] = self._number[row[last]]
        kept = order[place < self.depth]
        row, phrase, distance, rank = row[kept], phrase[kept], distance[kept], rank[kept]
        self._names = {i: self._names[i] for i in np.unique(phrase).tolist()}
        self._pending, self._size = [(row, phrase, distance, rank)], len(row)
        # Sorting what stays again costs no more than what was taken since.
        self._room = max(PENDING_PAIRS, 2 * self._size)
        return row, phrase, distance, rank

    def pairs(self) -> pa.RecordBatch | None:
        if not self._pending:
            return None
        row, phrase, distance, rank = self._cut()
        keys = [self.keys[i] for i in row.tolist()]
        columns = [pa.array([k[c] for k in keys], pa.string()) for c in range(len(FILING_KEYS))]
        columns += [
            pa.array([self.numbers[i] for i in row.tolist()], pa.int32()),
            pa.array([self._names[i] for i in phrase.tolist()], pa.string()),
            pa.array(rank),
            pa.array(distance),
        ]
        names = [*FILING_KEYS, "chunk_num", "phrase", "rank_distance", "distance"]
        return pa.RecordBatch.from_arrays(columns, names)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Runs of rows with the same salt and kind."""
    salt, kind = (batch.column(c).to_numpy() for c in ("salt", "kind"))
    changes = np.flatnonzero((np.diff(salt) != 0) | (np.diff(kind) != 0)) + 1
    bounds = [0, *changes.tolist(), len(salt)]
    for first, end in zip(bounds, bounds[1:]):
        if end > first:
            yield (salt[first], kind[first]), batch.slice(first, end - first)


def _salts(spark: SparkSession, parts: int) -> list[int]:
    """Numbers of which no two are shuffled to the same one of so many partitions.

    A partition that none of those looked at goes to is left out.
    """
    looked_at = spark.range(0, parts * (10 + parts.bit_length()), 1, 1)
    place = F.pmod(F.hash("id"), F.lit(parts))
    found = looked_at.groupBy(place.alias("place")).agg(F.min("id").alias("salt")).collect()
    return sorted(r.salt for r in found)


def _streamed(chunks: DataFrame, phrases: DataFrame, depth: int, held_bytes: int) -> DataFrame:
    """Chunks dealt out so that a task holds a bounded part, and all phrases stream by each.

    The phrases are repeated for every part; chunk vectors move once. Each part has a
    partition of its own, and runs of neighbouring chunks stay together, so that the pairs
    of a filing limit one another early. A part gives no more than ``depth`` pairs of a
    filing.
    """
    spark = chunks.sparkSession
    n, longest = chunks.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    parts = max(-(-n * 8 * (longest or 0) // held_bytes), spark.sparkContext.defaultParallelism)
    salts = F.lit(_salts(spark, parts)).cast("array<long>")
    run = F.floor(F.monotonically_increasing_id() / RUN)
    held = chunks.select(
        F.get(salts, F.pmod(run, F.size(salts)).cast("int")).alias("salt"),
        F.lit(0).alias("kind"),
        *FILING_KEYS,
        "chunk_num",
        F.lit(None).cast("string").alias("phrase"),
        F.col("embedding").alias("vector"),
    )
    nothing = [F.lit(None).cast("string").alias(k) for k in FILING_KEYS]
    stream = phrases.select(
        F.explode(salts).alias("salt"),
        F.lit(1).alias("kind"),
        *nothing,
        F.lit(None).cast("int").alias("chunk_num"),
        "phrase",
        F.col("phrase_embedding").alias("vector"),
    )
    dealt = held.unionByName(stream).repartition(parts, "salt")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, salt = None, None
        for batch in batches:
            for (at, kind), rows in _runs(batch):
                if at != salt:
                    if own is not None and (found := own.pairs()) is not None:
                        yield found
                    own, salt = None, at
                if kind == 0:
                    own = own or _Held(depth)
                    own.add(rows)
                elif own is not None:
                    own.meet(rows)
        if own is not None and (found := own.pairs()) is not None:
            yield found

    schema = (
        "cik string, accession_number string, chunk_num int, phrase string, "
        "rank_distance double, distance double"
    )
    return dealt.sortWithinPartitions("salt", "kind", "phrase").mapInArrow(meet, schema)


def _shipped(chunks: DataFrame, phrases: DataFrame, depth: int) -> DataFrame:
    """Every chunk with its ``depth`` nearest of a phrase set that goes to every task."""
    table = phrases.toArrow()
    names = table.column("phrase").to_pylist()
    order = sorted(range(len(names)), key=lambda i: (names[i] is not None, names[i] or ""))
    table = table.take(pa.array(order, pa.int64())).combine_chunks()
    asked = _matrices(table.column("phrase_embedding").chunk(0)) if len(table) else {}
    nearest = _nearest([names[i] for i in order], asked, depth)
    keys = [*FILING_KEYS, "chunk_num"]
    near = chunks.select(*keys, nearest("embedding").alias("near"))
    zipped = F.arrays_zip("near.rank_distance", "near.phrase", "near.distance")
    return near.select(*keys, F.inline(zipped))


def phrase_distances(
    vectors: DataFrame,
    phrases: DataFrame,
    depth: int,
    shipped_bytes: int = SHIPPED_BYTES,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """Pairs among which are the ``depth`` nearest of every filing, however many phrases there are.

    The phrases' number and longest vector are looked up first. A set of up to
    ``shipped_bytes`` is sent to where the vectors are read, and no vector moves. A
    larger one stays in Spark and streams by parts of the chunks.
    """
    chunks = vectors.select(*FILING_KEYS, "chunk_num", "embedding").where("embedding IS NOT NULL")
    phrases = phrases.select("phrase", "phrase_embedding").where("phrase_embedding IS NOT NULL")
    n, longest = phrases.agg(F.count(F.lit(1)), F.max(F.size("phrase_embedding"))).first()
    if n * 8 * (longest or 0) <= shipped_bytes:
        return _shipped(chunks, phrases, depth)
    return _streamed(chunks, phrases, depth, held_bytes)


def top_pairs(
    vectors: DataFrame,
    phrases: DataFrame,
    tag: str,
    depth: int = DEFAULT_DEPTH,
    shipped_bytes: int = SHIPPED_BYTES,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """Per filing the ``depth`` nearest pairs: keys, phrase, chunk_num, distance.

    The limit is on pairs, so one chunk can appear once for every phrase. Spark
    applies it before the exchange as well (WindowGroupLimit), hence a filing
    with very many chunks sends only ``depth`` rows from each input partition.
    """
    pairs = phrase_distances(vectors, with_tag(phrases, tag), depth, shipped_bytes, held_bytes)
    names = [*FILING_KEYS, "chunk_num", "phrase", "rank_distance", "distance"]
    return limit_per_group(
        pairs.select(*names), FILING_KEYS, ("rank_distance", "chunk_num", "phrase"), depth
    ).select(*FILING_KEYS, "phrase", "chunk_num", "distance")


GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
GROUP_SALTS = 64


def limit_per_group(df: DataFrame, keys, order, k: int) -> DataFrame:
    """First ``k`` rows of every group.

    Up to the session's threshold Spark limits groups before it shuffles them.
    Past that, groups are first cut over salts, so that no task sorts a whole
    large group.
    """
    threshold = int(df.sparkSession.conf.get(GROUP_LIMIT_CONF))
    if k > threshold:
        salt = F.pmod(F.xxhash64(*order), F.lit(GROUP_SALTS))
        salted = Window.partitionBy(*keys, salt).orderBy(*order)
        df = df.withColumn("_row", F.row_number().over(salted)).where(F.col("_row") <= k)
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_row", F.row_number().over(ranked))
        .where(F.col("_row") <= k)
        .drop("_row")
    )
