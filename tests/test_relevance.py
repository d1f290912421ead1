import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundglean.operators import relevance, search
from fundglean.operators.filters import with_tag
from fundglean.schemas import CHUNK_VECTORS, SEARCH_PHRASES


def scores_of(spark, distances):
    rows = [("1", "a", n, float(d)) for n, ds in distances.items() for d in ds]
    pairs = spark.createDataFrame(
        rows, "cik string, accession_number string, chunk_num int, distance double"
    )
    return relevance.chunk_scores(pairs)


def test_golden_scores(spark):
    distances = {159: [0.282, 0.345], 158: [0.291], 444: [0.311, 0.316]}
    rows = scores_of(spark, distances).collect()
    by_distance = sorted(rows, key=lambda r: r.distance_rank)
    assert [(r.chunk_num, round(r.distance_score, 6)) for r in by_distance] == [
        (158, 0.774593), (159, 0.761325), (444, 0.761325),
    ]
    by_appearance = sorted(rows, key=lambda r: r.appearance_rank)
    assert [(r.chunk_num, round(r.appearance_score, 6)) for r in by_appearance] == [
        (159, 1.522649), (444, 1.522649), (158, 0.774593),
    ]


@pytest.mark.parametrize(
    "ranked, near",
    [((7, 8, 9), [7, 8]), ((8, 7, 9), [7, 8, 9]), ((5, 9, 4), [4, 5]), ((3,), [3]), ((3, 9), [3])],
)
def test_adjacency_is_to_the_best_only(spark, ranked, near):
    scores = scores_of(spark, {n: [0.1 * (i + 1)] for i, n in enumerate(ranked)})
    picked = relevance.selected_chunks(scores, "distance").collect()
    assert picked[0].selected_chunks == near
    any3 = relevance.selected_chunks(scores, "distance-any3").collect()
    assert any3[0].selected_chunks == sorted(ranked)


def test_equal_lists_are_tried_once(spark):
    scores = scores_of(spark, {1: [0.1], 2: [0.2], 3: [0.3]})
    choices = relevance.selections(scores).collect()[0].choices
    assert [(c.ordinal, c.method, c.chunks) for c in choices] == [
        (0, "distance", [1, 2]), (2, "distance-any3", [1, 2, 3]),
    ]


def make_search(spark, seed=3, filings=4, per_filing=12, phrases=5):
    rng = random.Random(seed)

    def vector():
        return [rng.uniform(-1, 1) for _ in range(6)]

    chunks = [(str(f), "a", n, vector()) for f in range(filings) for n in range(per_filing)]
    chunks.append(("0", "a", 99, [0.0] * 6))
    asked = [(f"p{i}", vector(), ["g"]) for i in range(phrases)]
    asked += [("other", vector(), ["h"]), ("untagged", vector(), None)]
    vectors = spark.createDataFrame(chunks, CHUNK_VECTORS.schema)
    return vectors, spark.createDataFrame(asked, SEARCH_PHRASES.schema)


def brute_force(vectors, phrases, tag, k):
    out = defaultdict(list)
    asked = [p for p in phrases.collect() if p.tags and tag in p.tags]
    for row in vectors.collect():
        for p in asked:
            dot = sum(a * b for a, b in zip(row.embedding, p.phrase_embedding))
            size = math.sqrt(
                sum(a * a for a in row.embedding) * sum(b * b for b in p.phrase_embedding)
            )
            if size:
                out[row.cik].append((round(1 - dot / size, 9), row.chunk_num, p.phrase))
    return {(cik, *pair[1:]): pair[0] for cik, ps in out.items() for pair in sorted(ps)[:k]}


@pytest.mark.parametrize("k, size, threshold", [(7, 10**8, 1000), (7, 100, 1000), (9, 10**8, 5), (1, 0, 1000), (1000, 150, 1000), (9, 0, 5)])
def test_search_matches_brute_force(spark, k, size, threshold):
    """All ways through: phrases sent along or streaming, and a depth past the group limit."""
    vectors, phrases = make_search(spark)
    old = spark.conf.get(search.GROUP_LIMIT_CONF)
    spark.conf.set(search.GROUP_LIMIT_CONF, str(threshold))
    try:
        rows = search.top_pairs(vectors, phrases, "g", k, shipped_bytes=size, held_bytes=1000).collect()
    finally:
        spark.conf.set(search.GROUP_LIMIT_CONF, old)
    got = {(r.cik, r.chunk_num, r.phrase): round(r.distance, 9) for r in rows}
    assert len(got) == len(rows)
    assert got == brute_force(vectors, phrases, "g", k)


def test_search_limits_before_it_shuffles(spark):
    vectors, phrases = make_search(spark)
    pairs = search.top_pairs(vectors, phrases, "g", 20)
    plan = relevance.chunk_scores(pairs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # one exchange by filing carries the search, the scores and both ranks
    assert plan.count("Exchange hashpartitioning(cik") == 1


def test_no_tagged_phrase_finds_nothing(spark):
    vectors, phrases = make_search(spark)
    assert search.top_pairs(vectors, phrases.where(F.lit(True)), "none", 5).count() == 0


@pytest.mark.parametrize("block", [1, 3, 1024])
@pytest.mark.parametrize("size", [10**8, 60])
def test_odd_vectors_meet_nothing(spark, monkeypatch, size, block):
    """NULL, zero, short and long vectors, whatever the number of passes and blocks."""
    monkeypatch.setattr(search, "PHRASES_PER_BLOCK", block)
    monkeypatch.setattr(search, "CHUNKS_PER_PRODUCT", 2)
    one, two = [1.0, 0.0], [0.6, 0.8]
    odd = [None, [], [0.0, 0.0], [1.0], [1.0, 0.0, 0.0], [None, 1.0]]
    chunks = [("1", "a", n, v) for n, v in enumerate([one, *odd, two, one])]
    asked = [("p", one, ["g"]), ("q", two, ["g"]), ("p", one, ["g"]), (None, two, ["g"])]
    asked += [(f"odd{i}", v, ["g"]) for i, v in enumerate(odd)]
    vectors = spark.createDataFrame(chunks, CHUNK_VECTORS.schema)
    phrases = spark.createDataFrame(asked, SEARCH_PHRASES.schema)
    pairs = search.phrase_distances(vectors, with_tag(phrases, "g"), 100, shipped_bytes=size).collect()
    got = sorted((r.chunk_num, r.phrase or "", round(r.distance, 6)) for r in pairs)
    near = [(one, "p"), (one, "p"), (two, "q"), (two, "")]
    want = [(n, p, round(1 - (v[0] * u[0] + v[1] * u[1]), 6)) for n, v in ((0, one), (7, two), (8, one)) for u, p in near]
    want += [(4, "odd3", 0.0), (5, "odd4", 0.0)]  # vectors of one and of three numbers meet their like
    assert got == sorted(want)


def test_vectors_move_once_at_most(spark):
    """A bounded phrase set goes to the vectors; any other meets them in one exchange."""
    vectors, phrases = make_search(spark)
    found = search.phrase_distances(vectors, phrases, 5)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    found = search.phrase_distances(vectors, phrases, 5, shipped_bytes=0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(salt") == 1 and plan.count("Exchange") == 1
    assert plan.count("MapInArrow") == 1 and "Join" not in plan


def test_pairs_are_cut_while_phrases_stream():
    """More phrases than are kept, in several batches, with ties told by number and name."""
    rng = np.random.default_rng(3)
    held = search._Held(4)
    vectors = rng.integers(-2, 3, (300, 5)).astype(float)
    filings = [str(i % 7) for i in range(300)]
    held.add(pa.record_batch({"cik": filings, "accession_number": filings,
                              "chunk_num": pa.array(range(300), pa.int32()), "vector": vectors.tolist()}))
    phrases = rng.integers(-2, 3, (2500, 5)).astype(float)
    names = sorted(f"p{i}" for i in range(2500))
    for first in range(0, 2500, 900):
        some = slice(first, first + 900)
        held.meet(pa.record_batch({"phrase": names[some], "vector": phrases[some].tolist()}))
    got = held.pairs().to_pylist()
    with np.errstate(divide="ignore", invalid="ignore"):
        distance = 1 - vectors @ phrases.T / (
            np.linalg.norm(vectors, axis=1)[:, None] * np.linalg.norm(phrases, axis=1)[None, :])
    want = []
    for f in range(7):
        pairs = [(round(distance[i, j], 12) + 0.0, i, names[j]) for i in range(f, 300, 7) for j in range(2500)
                 if not np.isnan(distance[i, j])]
        want += [(str(f), i, name) for _, i, name in sorted(pairs)[:4]]
    assert sorted((r["cik"], r["chunk_num"], r["phrase"]) for r in got) == sorted(want)
    assert len(held._names) <= 28


def test_kept_pairs_are_not_sorted_again_for_every_block(monkeypatch):
    """Cuts grow in number with the pairs taken, not with the blocks that meet many filings."""
    cuts = []
    cut = search._Held._cut
    monkeypatch.setattr(search._Held, "_cut", lambda self: cuts.append(1) or cut(self))
    monkeypatch.setattr(search, "PENDING_PAIRS", 50)
    monkeypatch.setattr(search, "PHRASES_PER_BLOCK", 10)
    rng = np.random.default_rng(5)
    filings = [str(i) for i in range(100)]
    held = search._Held(4)
    held.add(pa.record_batch({"cik": filings, "accession_number": filings, "chunk_num": pa.array([0] * 100, pa.int32()),
                              "vector": rng.normal(size=(100, 5)).tolist()}))
    phrases = rng.normal(size=(3000, 5))
    held.meet(pa.record_batch({"phrase": [f"{i:04d}" for i in range(3000)], "vector": phrases.tolist()}))
    assert held.pairs().num_rows == 400
    assert len(cuts) < 30  # of 300 blocks


def test_each_part_of_the_chunks_has_a_task(spark):
    vectors, phrases = make_search(spark, filings=64, per_filing=16)
    found = search.phrase_distances(vectors, phrases, 5, shipped_bytes=0)
    tasks = found.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks == spark.sparkContext.defaultParallelism
