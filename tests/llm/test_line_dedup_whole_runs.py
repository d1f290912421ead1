import random

import pytest

from fundglean.llm import line_dedup
from test_line_dedup import plain

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("min_words", [1, 3, 5, 12])
def test_maximal_runs_go_whole(spark, min_words):
    rng = random.Random(min_words)
    vocabulary = ["a", "b b", "c", "d d d", "", "e", "f f f f f f f", "g g g g"]
    docs = [
        (n, "\n".join(rng.choice(vocabulary[: rng.choice([3, 8])]) for _ in range(rng.randint(1, 30))))
        for n in range(40)
    ]
    docs.append((99, docs[5][1]))
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, SCHEMA), min_words).collect()
    assert {(r["doc_id"], r["text"]) for r in got} == {(d[0], left) for d, left in plain(docs, min_words).items()}


def test_the_tail_of_a_run_goes_too(spark):
    sixty, forty = "long " * 59 + "end", "short " * 39 + "end"
    docs = [(1, f"{sixty}\n{forty}\nx"), (2, f"{sixty}\n{forty}\ny"), (3, f"{sixty}\n{forty}\nx")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == {1: docs[0][1], 2: "y", 3: ""}
