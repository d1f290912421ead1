import itertools
import math
import random

import pytest

from fundglean.llm import decontaminate as dec

SCHEMA = "doc_id long, text string, row_key string, item_ids string"


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def plain(text, items):
    """Ids of the items with an overlap, by comparing all windows."""
    codes = [w.strip(dec.PUNCTUATION.decode()) for w in (text or "").lower().split()]
    found = set()
    for item, other in items:
        b = [w.strip(dec.PUNCTUATION.decode()) for w in (other or "").lower().split()]
        size = min(13, len(b))
        if size == 0:
            continue
        need = math.ceil(0.8 * size) if size >= 8 else size
        for i, j in itertools.product(range(len(codes) - size + 1), range(len(b) - size + 1)):
            if sum(x == y for x, y in zip(codes[i : i + size], b[j : j + size], strict=True)) >= need:
                found.add(item)
    return found


def test_masks_miss_no_window_with_two_substitutions():
    for pair in itertools.combinations(range(13), 2):
        hit = any(
            not any(mask[p - start] == "1" for p in pair if 0 <= p - start < 8)
            for mask in dec.MASKS
            for start in range(6)
        )
        assert hit, pair


def test_against_all_windows(spark):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, rng.choice([3, 8, 10, 12, 13, 20, 40, 40])))) for i in range(30)]
    docs = []
    for i in range(120):
        own = words(rng, rng.randint(0, 60))
        taken = rng.choice(items)[1].split()
        first = rng.randrange(1 + len(taken) // 2) * rng.randint(0, 1)
        piece = taken[first : first + rng.randint(8, 40)]
        for _ in range(rng.randint(0, 3)):
            piece[rng.randrange(len(piece))] = "other"
        at = rng.randint(0, len(own))
        docs.append((i, " ".join(own[:at] + [w.upper() + "." for w in piece] + own[at:]), "x", None))
    got = dec.contamination(
        spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    by_id = {r["doc_id"]: r for r in got}
    hits = 0
    for i, text, *_ in docs:
        want = plain(text, items)
        assert set(by_id[i]["item_ids"]) == want and by_id[i]["contaminated"] == bool(want)
        hits += bool(want)
    assert 30 < hits < 110


@pytest.fixture
def odd(spark):
    said = " ".join(words(random.Random(2), 20))
    rows = [(1, None), (2, ""), (3, said), (3, said), (None, "x y " + said), (4, "a " * 30_000 + said), (5, "z z z")]
    return (
        spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA),
        spark.createDataFrame([(7, said, 1), (7, said, 1), (None, said, 2), (8, None, 3), (9, "z z z", 4)],
                              "item_id long, text string, kind int"),
    )


def test_edge_cases(odd):
    docs, items = odd
    got = dec.contamination(docs, items).collect()
    assert sorted((r["doc_id"] or 0, r["contaminated"]) for r in got) == [
        (0, True), (1, False), (2, False), (3, True), (3, True), (4, True), (5, True)
    ]
    assert {tuple(r["item_ids"]) for r in got if r["contaminated"]} == {(7,), (9,)}
    kept = dec.decontaminate(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    assert dec.contamination(docs.limit(0), items).collect() == []
    assert not any(r["contaminated"] for r in dec.contamination(docs, items.limit(0)).collect())


def test_a_full_filter_changes_nothing(odd, monkeypatch):
    docs, items = odd
    want = sorted(map(str, dec.contamination(docs, items).collect()))
    monkeypatch.setattr(dec, "FILTER_BITS", 7)
    assert sorted(map(str, dec.contamination(docs, items).collect())) == want
