import random
from collections import Counter

import pytest

from fundglean.llm import line_dedup

SCHEMA = "doc_id long, text string, n_deleted string, dedup_key string"


def plain(docs, min_words):
    """What is left of each (id, text), by extending every pair of equal lines as far as it goes.

    Rows with the same id and text are one document.
    """
    keys = sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is not None, d[0] or 0))
    full = []
    for doc in keys:
        lines = doc[1].split("\n")
        full.append((doc, [(k, x, len(x.split())) for k, x in enumerate(lines) if x.split()]))
    gone = {}
    for later, (doc, own) in enumerate(full):
        for _, other in full[: later + 1]:
            same = other is own
            for i in range(len(own)):
                for j in range(i if same else len(other)):
                    n = words = 0
                    while i + n < len(own) and j + n < len(other) and own[i + n][1] == other[j + n][1]:
                        words += own[i + n][2]
                        n += 1
                    if n and words >= min_words:
                        gone.setdefault(doc, set()).update(range(own[i][0], own[i + n - 1][0] + 1))
    return {
        d: None if d[1] is None else "\n".join(x for k, x in enumerate(d[1].split("\n")) if k not in gone.get(d, ()))
        for d in docs
    }


@pytest.mark.parametrize("min_words", [1, 3, 5, 12])
def test_against_plain_python(spark, min_words):
    rng = random.Random(min_words)
    vocabulary = ["a", "b b", "c", "d d d", "", "e", " "]
    docs = [
        (n, "\n".join(rng.choice(vocabulary[: rng.choice([3, 7])]) for _ in range(rng.randint(0, 30))))
        for n in range(50)
    ]
    docs += [docs[3], docs[7], (99, docs[5][1]), (100, None), (100, None), (101, ""), (None, docs[2][1])]
    df = spark.createDataFrame([(*d, "x", None) for d in docs], SCHEMA)
    got = line_dedup.dedup_lines(df, min_words)
    assert got.columns == ["doc_id", "text", "dedup_key", "n_deleted"]
    want = plain(docs, min_words)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter((d[0], want[d]) for d in docs)


def test_long_texts_and_runs(spark):
    block = "\n".join(f"w{i} x" for i in range(400))
    docs = [(1, block + "\nend of one"), (2, "start of two\n" + block), (3, "solo " * 30_000)]
    df = spark.createDataFrame([(*d, "x", None) for d in docs], SCHEMA)
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert (got[1]["n_deleted"], got[3]["n_deleted"]) == (0, 0)
    assert got[2]["text"] == "start of two" and got[2]["n_deleted"] == 400


def test_a_passage_of_fifty_words(spark):
    said, short = "word " * 49 + "end", "word " * 48 + "end"
    docs = [(1, f"a\n{said}\nb"), (2, f"c\n{said}\nd"), (3, f"e\n{short}\nf"), (4, f"g\n{short}\nh")]
    df = spark.createDataFrame([(*d, "x", None) for d in docs], SCHEMA)
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: docs[0][1], 2: "c\nd", 3: docs[2][1], 4: docs[3][1]}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert line_dedup.dedup_lines(df).collect() == []
    assert line_dedup.dedup_lines(spark.createDataFrame([(1, "x\nx", "", "")], SCHEMA)).count() == 1
