import random

import numpy as np
import pytest
import xxhash

from fundglean.llm import simhash
from fundglean.llm.common import words_of

SCHEMA = "doc_id long, text string, fingerprint string, row_key string"


def plain_fingerprint(text):
    words = words_of(None if text is None else text.encode())
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=3):
    """Component number of each fingerprint, by comparing all pairs."""
    group = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= bits and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def flipped(rng, x, n):
    for b in rng.sample(range(64), n):
        x ^= 1 << b
    return x


@pytest.mark.parametrize("size", [1, 2, 255, 256, 1000])
def test_bit_sums(size):
    x = np.random.default_rng(size).integers(0, 2**64, size, dtype=np.uint64)
    assert simhash.bit_sums(x).tolist() == [int((x >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)]


def test_pieces_of_a_long_text(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=500))
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint_of(text.encode(), 3) == plain_fingerprint(text)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_lose_nothing(spark, bits):
    """Random clusters, chains of neighbours and far points give the components of all pairs."""
    rng = random.Random(bits)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for x in list(prints)[:20]:
        for _ in range(6):
            x = flipped(rng, x, rng.randint(1, 4))
            prints.add(x)
    prints = sorted(prints)
    rows = [(simhash.signed(x),) for x in prints]
    df = spark.createDataFrame(rows, "fingerprint long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, bits)).collect()}
    got = [roots.get(x, x) for (x,) in rows]
    want = plain_components(prints, bits)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_every_pair_within_three_bits_meets():
    """The chain and its key find each pattern of up to three differing bits that is drawn."""
    rng = random.Random(7)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = flipped(rng, a, rng.randint(1, 3))
        differing = np.bitwise_count(simhash.segments(np.array([a ^ b], np.uint64)))
        keys = 0
        for start in range(8):
            if simhash.chain_holds(differing, start, 3)[0]:
                ring = [int(differing[0][(start + i) % 8]) for i in range(8)]
                keys += any(ring[0] + ring[1] + ring[i] + ring[j] == 0 for i, j in simhash.PICKS)
        assert keys


def test_dense_buckets_give_a_forest(monkeypatch):
    """Thousands of near fingerprints of one bucket: fewer links than members, same groups."""
    rng = random.Random(2)
    base = rng.getrandbits(64)
    low = sorted({sum(1 << b for b in rng.sample(range(16), rng.randint(0, 8))) for _ in range(300)})
    members = np.array([simhash.signed(base ^ x) for x in low])
    wanted = len(set(plain_components(low)))
    for block in (1, 1000, 1 << 18):
        monkeypatch.setattr(simhash, "BLOCK", block)
        group = list(range(len(low)))
        for start in range(8):
            links = simhash.forest(members, start, 3)
            assert len(links) < len(members)
            for i, j in links:
                assert bin(low[i] ^ low[j]).count("1") <= 3
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
        assert len(set(group)) == wanted


def test_too_many_bits(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.range(1).withColumnRenamed("id", "fingerprint"), 4)


ROWS = [
    (5, None, "x", "y"),
    (4, "", None, "y"),
    (9, "one two", "x", "y"),
    (9, "one two", "x", "y"),
    (7, "One TWO", "x", "y"),
    (None, "one two", "x", "y"),
    (12, "a b c d e " * 3000, "x", "y"),
    (3, "quite another text stands here", "x", None),
]


def test_edge_cases(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = simhash.near_duplicates(df).collect()
    want = {(r[0], simhash.signed(plain_fingerprint(r[1]))) for r in ROWS}
    assert {(r["doc_id"], r["fingerprint"]) for r in got} == want and len(got) == len(ROWS)
    component = {r["doc_id"]: r["component_id"] for r in got}
    assert component == {5: 4, 4: 4, 9: 7, 7: 7, None: 7, 12: 12, 3: 3}
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_one_of_each(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [3, 4, 7, 12]
    twice = spark.createDataFrame([ROWS[2]] * 3, SCHEMA)
    assert simhash.one_of_each(twice).count() == 1
    assert simhash.one_of_each(df.limit(0)).count() == 0


def test_chains_prune_before_the_full_check():
    """Pairs of a bucket (two equal segments, and two of the next three): few are checked whole."""
    rng = np.random.default_rng(5)
    for start in range(8):
        far = rng.integers(0, 2**64, 20_000, dtype=np.uint64) & rng.integers(0, 2**64, 20_000, dtype=np.uint64)
        ring = far & ~np.uint64(0xFFFFFFFF)  # segments 0 to 3 of the chain are equal
        near = np.uint64(1) << rng.integers(32, 64, 50).astype(np.uint64)
        ring = np.concatenate([ring, near])
        turn = np.uint64(8 * start)
        differing = ring if start == 0 else (ring << turn) | (ring >> (np.uint64(64) - turn))
        checked = simhash.survivors(differing, start, 3)
        assert len(checked) < 0.2 * len(differing)
        holds = simhash.chain_holds(np.bitwise_count(simhash.segments(differing)), start, 3)
        whole = checked[np.bitwise_count(differing[checked]) <= 3]
        assert whole.tolist() == np.flatnonzero(holds).tolist()
