"""Merkle manifest of a dataset: a tree of hashes for each source, and one over the sources.

A leaf is the SHA-256 of a row's fields, each ``-`` if null, else its UTF-8 byte count, a
colon and its value. Leaves of a source ascend by id; runs of three neighbours are hashed
together, level by level, until one node is left, the source's subroot. Subroots in the
order of the sources (null first, then bytewise) give the root in the same way.

Leaves are ordered by a range partitioning, never by one task for a source, and numbered
by counts of its partitions. A leaf partition is a block of ``3 ** BLOCK_LEVELS``
neighbours of one source, so its own root is a node of the tree: blocks are folded each in
one task, the block roots are the leaves of the next round, and so on. Proofs are made by an
octopus multiproof: each leaf partition works out the coordinates of the nodes that any of
its proofs needs and that do not follow from its own leaves, the union of them once each,
fetches them by one join with the table of nodes, derives the nodes that its proofs share,
and expands the proof of every leaf locally. Proofs of chosen leaves only work the same
way, with more nodes fetched.

Edge cases: a null id sorts first; rows with the same id are ordered by their hashes, and
equal rows are leaves of their own, so their proofs differ although their hashes do not;
a source with one row has its leaf as subroot, and a single source its subroot as root;
an empty table gives no rows; columns other than the hashed ones play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundglean.llm.common import checkpoint, fold

# The hashed fields in their order, and the number of nodes of a run.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
BLOCK_LEVELS = 7  # a leaf partition has up to 2,187 leaves
SOURCE, TOP = 0, 1  # trees of sources, and the tree over them
NODE = "zone int, tree string, level int, at long, hash string"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value: Column) -> Column:
    """``-`` for a null, else the number of UTF-8 bytes, a colon, and the value as text."""
    said = value.cast("string")
    sized = F.concat(F.octet_length(said).cast("string"), F.lit(":"), said)
    return F.when(value.isNull(), "-").otherwise(sized)


def leaf_hash(replaced: dict[str, Column] | None = None) -> Column:
    """The leaf of a row; ``replaced`` gives other values for some of its fields."""
    values = {name: F.col(name) for name in FIELDS} | (replaced or {})
    return F.sha2(F.concat(*[encoded(values[name]) for name in FIELDS]), 256)


def tree_name(source: Column) -> Column:
    """A text for each source that sorts null first and is never null."""
    said = source.cast("string")
    return F.when(said.isNull(), "").otherwise(F.concat(F.lit("+"), said))


@dataclass
class Tree:
    """Leaves with their places, and the tables of nodes above them."""

    leaves: DataFrame  # doc_id, source, tree, place, n, top_place, leaf, seen
    inner: DataFrame  # nodes within leaf partitions, without the leaves themselves
    upper: DataFrame  # block roots and the nodes above them, up to the root
    n_trees: int
    levels: int  # of a leaf partition


def places(rows: DataFrame) -> DataFrame:
    """Add ``place`` and ``n`` in and of its tree, and ``top_place`` of the tree, all from 0.

    Every partition of the ordered rows counts its rows of each tree; what is summed up
    over partitions are these counts.
    """
    tied = rows.withColumn("copy", F.monotonically_increasing_id())
    order = ["tree", "doc_id", "leaf", "seen", "copy"]
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ordered = checkpoint(
        tied.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("copy")
        .withColumn("part", F.spark_partition_id())
        .withColumn("row", row)
    )
    in_tree = Window.partitionBy("tree")
    earlier = in_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        ordered.groupBy("tree", "part")
        .agg(F.count(F.lit(1)).alias("own"), F.min("row").alias("first"))
        .withColumn("before", F.coalesce(F.sum("own").over(earlier), F.lit(0)) - F.col("first"))
        .withColumn("n", F.sum("own").over(in_tree))
        .select("tree", "part", "before", "n")
    )
    trees = counts.select("tree").distinct().repartitionByRange("tree").sortWithinPartitions("tree")
    trees = checkpoint(
        trees.withColumn("group", F.spark_partition_id()).withColumn("inside", row)
    )
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = trees.groupBy("group").agg(F.count(F.lit(1)).alias("own"))  # a row for each partition
    groups = groups.select("group", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("start"))
    numbered = trees.join(groups, "group").select(
        "tree", (F.col("start") + F.col("inside")).alias("top_place")
    )
    placed = ordered.join(counts.join(numbered, "tree"), ["tree", "part"])
    return checkpoint(
        placed.withColumn("place", F.col("before") + F.col("row")).drop("part", "row", "before")
    )


def folded(nodes: DataFrame, levels: int, zone: int) -> DataFrame:
    """Nodes above the given ones within blocks of ``ARITY ** levels`` of them.

    ``nodes`` has ``tree``, ``level``, ``at``, ``hash`` and ``size``, how many nodes the
    level has; so has the result, with ``last`` for what a block ends with (a node alone
    on its level is that itself).
    """
    block = F.floor(F.col("at") / ARITY**levels)

    def fold_block(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        tree, level, size = (table.column(c)[0].as_py() for c in ("tree", "level", "size"))
        at, hashes = table.column("at")[0].as_py(), table.column("hash").to_pylist()
        rows: list[tuple] = []
        if size == 1:
            rows.append((zone, tree, level, at, hashes[0], size, True))
        for step in range(levels):
            if size == 1:
                break
            hashes = [digest(*hashes[i : i + ARITY]) for i in range(0, len(hashes), ARITY)]
            level, at, size = level + 1, at // ARITY, -(-size // ARITY)
            last = size == 1 or step + 1 == levels
            rows += [(zone, tree, level, at + i, h, size, last) for i, h in enumerate(hashes)]
        columns = list(zip(*rows, strict=True))
        types = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        names = ["zone", "tree", "level", "at", "hash", "size", "last"]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    given = nodes.select("tree", "level", "at", "hash", "size", block.alias("block"))
    return given.groupBy("tree", "block").applyInArrow(fold_block, f"{NODE}, size long, last boolean")


def climbed(nodes: DataFrame, largest: int, levels: int, zone: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes of each round of blocks above the given ones, and the roots of their trees.

    ``largest`` is the number of nodes of the largest tree, which says how many rounds
    there are.
    """
    rounds, roots = [], None
    while True:
        found = checkpoint(folded(nodes, levels, zone))
        rounds.append(found)
        done = found.where("last AND size = 1").select("tree", "hash")
        roots = done if roots is None else roots.unionAll(done)
        largest = -(-largest // ARITY**levels)
        if largest <= 1:
            return rounds, roots
        nodes = found.where("last AND size > 1")


def manifest(
    docs: DataFrame, tampered: dict[str, Column] | None = None, levels: int = BLOCK_LEVELS
) -> Tree:
    """The tree of ``docs``.

    ``tampered`` gives fields of the rows as somebody found them later; column ``seen`` has
    the leaf made of these, to be held against the tree.
    """
    leaf = leaf_hash()
    rows = docs.select(
        "doc_id",
        "source",
        tree_name(F.col("source")).alias("tree"),
        leaf.alias("leaf"),
        (leaf_hash(tampered) if tampered else leaf).alias("seen"),
    )
    leaves = places(rows)
    largest, n_trees = leaves.agg(F.max("n"), F.max("top_place") + 1).first()
    first = leaves.select(
        "tree", F.lit(0).alias("level"), F.col("place").alias("at"), F.col("leaf").alias("hash"),
        F.col("n").alias("size"),
    )
    inner, subroots = climbed(first, largest or 0, levels, SOURCE)
    names = leaves.where("place = 0").select("tree", "top_place")
    top = subroots.join(names, "tree").select(
        F.lit("").alias("tree"), F.lit(0).alias("level"), F.col("top_place").alias("at"), "hash",
        F.lit(n_trees or 0).cast("long").alias("size"),
    )
    above, _ = climbed(checkpoint(top), n_trees or 0, levels, TOP)
    columns = ["zone", "tree", "level", "at", "hash"]
    upper = inner[0].where("last").select(*columns)
    for found in [*inner[1:], *above]:
        upper = upper.unionAll(found.select(*columns))
    upper = upper.unionAll(top.select(F.lit(TOP).alias("zone"), *columns[1:]))
    below = inner[0].where("NOT last").select(*columns)
    return Tree(leaves, below, upper, n_trees or 0, levels)


def missing(at: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per level, what proofs of the nodes at ``at`` need beside what follows from these.

    The smallest such set: each coordinate once, none that can be derived.
    """
    level, known = 0, np.unique(at)
    while size > 1:
        runs = np.unique(known // ARITY)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        yield level, np.setdiff1d(members[members < size], known, assume_unique=True)
        level, known, size = level + 1, runs, -(-size // ARITY)


def wanted_nodes(blocks: DataFrame, n_trees: int) -> DataFrame:
    """``tree``, ``block`` and the coordinates of the nodes its proofs have to fetch."""

    @F.pandas_udf("array<struct<zone:int,level:int,at:long>>")
    def coordinates(at: pd.Series, size: pd.Series, top: pd.Series) -> pd.Series:
        def one(at, size, top):
            trees = (SOURCE, missing(np.asarray(at), size)), (TOP, missing(np.asarray([top]), n_trees))
            return [(z, level, int(x)) for z, found in trees for level, xs in found for x in xs]

        return pd.Series([one(*row) for row in zip(at, size, top, strict=True)], dtype=object)

    found = coordinates("at", "n", "top_place")
    return blocks.select("tree", "block", F.inline(found))


def expanded(leaves: pa.Table, fetched: pa.Table, n_trees: int) -> dict[str, list[str]]:
    """Proof, subroot, root and folded root of each leaf of one leaf partition.

    Nodes that several proofs share are derived once; whatever is not fetched follows
    from the leaves.
    """
    have: dict[tuple[int, int], dict[int, str]] = {}
    names = ("zone", "level", "at", "hash")
    for zone, level, at, node in zip(*(fetched.column(c).to_pylist() for c in names), strict=True):
        have.setdefault((zone, level), {})[at] = node

    def risen(zone: int, nodes: dict[int, str], size: int) -> tuple[list[dict[int, list[str]]], str]:
        """The runs of each level by their place, and the root."""
        levels, level = [], 0
        while size > 1:
            nodes = have.get((zone, level), {}) | nodes
            runs: dict[int, list[str]] = {}
            for at in sorted(nodes):
                runs.setdefault(at // ARITY, []).append(nodes[at])
            levels.append(runs)
            nodes = {run: digest(*members) for run, members in runs.items()}
            level, size = level + 1, -(-size // ARITY)
        return levels, nodes[0]

    at, own = leaves.column("place").to_pylist(), leaves.column("leaf").to_pylist()
    top = leaves.column("top_place")[0].as_py()
    below, subroot = risen(SOURCE, dict(zip(at, own, strict=True)), leaves.column("n")[0].as_py())
    above, root = risen(TOP, {top: subroot}, n_trees)
    proofs, folds = [], []
    for place, node in zip(at, leaves.column("seen").to_pylist(), strict=True):
        siblings: list[str] = []
        for levels, here in ((below, place), (above, top)):
            for runs in levels:
                here, j = divmod(here, ARITY)
                left, right = runs[here][:j], runs[here][j + 1 :]
                siblings += left + right
                node = digest(*left, node, *right)
        proofs.append(digest(*siblings))
        folds.append(node)
    return {
        "proof_sha256": proofs,
        "folded_root": folds,
        "subroot": [subroot] * len(at),
        "root": [root] * len(at),
    }


def proofs(tree: Tree, chosen: DataFrame | None = None) -> DataFrame:
    """``doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified`` of leaves.

    All of them, or those of the ids in ``chosen`` (``doc_id``), whose proofs also fetch
    leaves and nodes of their own leaf partitions.
    """
    leaves, nodes = tree.leaves, tree.upper
    if chosen is not None:
        columns = ["zone", "tree", "level", "at", "hash"]
        zeroth = leaves.select(
            F.lit(SOURCE).alias("zone"), "tree", F.lit(0).alias("level"),
            F.col("place").alias("at"), F.col("leaf").alias("hash"),
        )
        nodes = nodes.unionAll(tree.inner).unionAll(zeroth.select(*columns)).distinct()
        leaves = leaves.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi")
    leaves = leaves.withColumn("block", F.floor(F.col("place") / ARITY**tree.levels))
    blocks = leaves.groupBy("tree", "block").agg(
        F.sort_array(F.collect_list("place")).alias("at"),
        F.first("n").alias("n"),
        F.first("top_place").alias("top_place"),
    )
    wanted = wanted_nodes(blocks, tree.n_trees)
    own = F.when(F.col("zone") == TOP, "").otherwise(F.col("tree"))
    on = ["zone", "at_tree", "level", "at"]
    fetched = (
        wanted.withColumn("at_tree", own)
        .join(nodes.withColumnRenamed("tree", "at_tree"), on)
        .select(F.col("tree").alias("of"), F.col("block").alias("part"), "zone", "level", "at", "hash")
    )
    n_trees = tree.n_trees
    kept = ["doc_id", "source", "leaf"]
    added = ["subroot", "root", "proof_sha256", "folded_root"]

    def expand(mine: pa.Table, needed: pa.Table) -> pa.Table:
        found = expanded(mine, needed, n_trees)
        same = [a == b for a, b in zip(found["folded_root"], found["root"], strict=True)]
        columns = [mine.column(c) for c in kept] + [pa.array(found[c], pa.string()) for c in added]
        return pa.table([*columns, pa.array(same)], [*kept, *added, "verified"])

    types = [f"{c} {leaves.schema[c].dataType.simpleString()}" for c in kept]
    ddl = ", ".join([*types, *[f"{c} string" for c in added], "verified boolean"])
    own_nodes = fetched.groupBy("of", "part")
    return leaves.groupBy("tree", "block").cogroup(own_nodes).applyInArrow(expand, ddl)


def without_newlines(modulus: int = 2) -> dict[str, Column]:
    """The tampering: the texts of every ``modulus``-th fold of ids lose their newlines."""
    text = F.col("text")
    cut = F.replace(text, F.lit("\n"), F.lit(""))
    return {"text": F.when(fold("doc_id", modulus) == 0, cut).otherwise(text)}


def sql() -> str:
    """SQL for all proofs of ``documents`` tampered with by ``without_newlines``."""

    def leaf(text: str) -> str:
        values = ["doc_id", "source", "lang", "n_chars", text]
        fields = [
            f"coalesce(octet_length(encode({v}::VARCHAR)) || ':' || {v}::VARCHAR, '-')" for v in values
        ]
        return f"sha256({' || '.join(fields)})"

    def third(n: str) -> str:
        return f"floor(({n}) / 3)::BIGINT"

    step = "CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END"
    shifted = f"list_reduce(range(8), lambda r, i: {step}, xor(c, b::BIGINT))"
    crc = f"""xor(4294967295, list_reduce(
        list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)),
        lambda c, b: {shifted}, 4294967295::BIGINT))"""
    cut = f"CASE WHEN coalesce({crc}, 0) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    return f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, source, {leaf("text")} AS leaf, {leaf(f"({cut})")} AS seen FROM documents
), placed AS (
    SELECT *, row_number() OVER w - 1 AS place, count(*) OVER (PARTITION BY source) AS n,
        dense_rank() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS tree,
        row_number() OVER () AS row
    FROM hashed WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, seen)
), sources AS (
    SELECT 0 AS level, tree, place AS spot, leaf AS hash, n AS size FROM placed
    UNION ALL
    SELECT level + 1, tree, {third('spot')}, sha256(string_agg(hash, '' ORDER BY spot)), {third('size + 2')}
    FROM sources WHERE size > 1 GROUP BY level, tree, {third('spot')}, size
), top AS (
    SELECT 0 AS level, -1::BIGINT AS tree, tree AS spot, hash, (SELECT count(DISTINCT tree) FROM placed) AS size
    FROM sources WHERE size = 1
    UNION ALL
    SELECT level + 1, tree, {third('spot')}, sha256(string_agg(hash, '' ORDER BY spot)), {third('size + 2')}
    FROM top WHERE size > 1 GROUP BY level, tree, {third('spot')}, size
), runs AS (
    SELECT level, tree, {third('spot')} AS run, list(hash ORDER BY spot) AS members
    FROM (SELECT * FROM sources UNION ALL SELECT * FROM top) WHERE size > 1 GROUP BY ALL
), depth AS (
    SELECT tree, max(level) AS levels FROM (SELECT * FROM sources UNION ALL SELECT * FROM top) GROUP BY tree
), path AS (
    SELECT row, tree AS top_at, tree, 0 AS level, place AS spot, seen AS node, '' AS said, false AS done FROM placed
    UNION ALL
    SELECT p.row, p.top_at,
        CASE WHEN r.run IS NULL THEN -1 ELSE p.tree END,
        CASE WHEN r.run IS NULL THEN 0 ELSE p.level + 1 END,
        CASE WHEN r.run IS NULL THEN p.top_at ELSE {third('p.spot')} END,
        CASE WHEN r.run IS NULL THEN p.node ELSE sha256(list_aggregate(
            r.members[1 : p.spot % 3] || [p.node] || r.members[p.spot % 3 + 2 :], 'string_agg', '')) END,
        CASE WHEN r.run IS NULL THEN p.said ELSE concat(p.said, list_aggregate(
            r.members[1 : p.spot % 3] || r.members[p.spot % 3 + 2 :], 'string_agg', '')) END,
        r.run IS NULL AND p.tree = -1
    FROM path p LEFT JOIN runs r ON r.tree = p.tree AND r.level = p.level AND r.run = {third('p.spot')}
    WHERE NOT p.done
)
SELECT d.doc_id, d.source, d.leaf, s.hash AS subroot, t.hash AS root, sha256(p.said) AS proof_sha256,
    p.node AS folded_root, p.node = t.hash AS verified
FROM placed d JOIN path p ON p.row = d.row AND p.done
    JOIN sources s ON s.tree = d.tree AND s.size = 1 JOIN top t ON t.size = 1
"""
