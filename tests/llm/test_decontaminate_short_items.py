import itertools
import random

import pytest

from fundglean.llm import decontaminate as dec


@pytest.mark.parametrize("size", range(8, 13))
def test_short_masks_miss_no_substitutions(size):
    assert dec.enough(size) == {8: 7, 9: 8, 10: 8, 11: 9, 12: 10}[size]
    for changed in itertools.combinations(range(size), size - dec.enough(size)):
        assert any(not set(mask) & set(changed) for mask in dec.short_masks(size)), changed


def test_short_items_with_replaced_words(spark):
    rng = random.Random(4)
    items = [(n, [f"i{n}w{k}" for k in range(n)]) for n in range(1, 13)]
    docs, want = [], {}
    for n, words in items:
        for changed in range(5):
            piece = list(words)
            for k in rng.sample(range(n), min(n, changed)):
                piece[k] = "other"
            doc = n * 10 + changed
            docs.append((doc, " ".join(["before", *piece, "after"])))
            want[doc] = [n] if n - changed >= (0.8 * n if n >= 8 else n) else []
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items] + [(99, " ")], "item_id long, text string")
    got = dec.contamination(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    assert {r["doc_id"]: r["item_ids"] for r in got} == want
    status = {r["item_id"]: r["status"] for r in dec.item_status(benchmark).collect()}
    assert status == {n: "unchanged" for n in range(1, 8)} | {n: "whole" for n in range(8, 13)} | {99: "empty"}


def test_ids_of_any_type(spark):
    said = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([("d1", said), ("d2", "nothing here"), (None, "a b")], "doc_id string, text string")
    items = spark.createDataFrame([("i1", said), ("i2", "a b")], "item_id string, text string")
    got = {r["doc_id"]: r["item_ids"] for r in dec.contamination(docs, items).collect()}
    assert got == {"d1": ["i1"], "d2": [], None: ["i2"]}
    assert [r["doc_id"] for r in dec.decontaminate(docs, items).collect()] == ["d2"]


def test_repeated_words_make_few_hits(spark):
    """An item and a document of one word: what is compared alike is one hit."""
    docs = spark.createDataFrame([(1, "a " * 20_000), (2, "b a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a " * 500), (2, "a a a"), (3, "b")], "item_id long, text string")
    found = dec.overlaps(docs, items)
    assert found.count() < 2 * 40 * 40
    got = {r["doc_id"]: r["item_ids"] for r in dec.contamination(docs, items).collect()}
    assert got == {1: [1, 2], 2: [3]}
