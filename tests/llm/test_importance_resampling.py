import math
import random

import numpy as np

from fundglean.llm import importance_resampling as res

SCHEMA = "doc_id long, text string, kept string, log_weight string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)


def test_weights_against_plain_python(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["ab", "cd!", "ef", "%%", "gh"], k=rng.randint(1, 30))) for _ in range(40)]
    rows = list(enumerate(texts)) + [(90, None), (91, "")]
    docs = frame(spark, rows)
    target = spark.createDataFrame([(i,) for i in range(0, 40, 3)], "doc_id long")
    got = {r["doc_id"]: r for r in res.importance_sample(docs, target, (1, 2)).collect()}
    counts = [np.ones(res.BUCKETS), np.ones(res.BUCKETS)]
    for i, text in rows:
        for f in res.features(None if text is None else text.encode()):
            counts[1][f] += 1
            counts[0][f] += i % 3 == 0 and i < 40
    ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    for i, text in rows:
        want = sum(ratio[f] for f in res.features(None if text is None else text.encode()))
        assert math.isclose(got[i]["log_weight"], want, abs_tol=1e-9)
    keys = sorted((r["sample_key"] for r in got.values()), reverse=True)
    assert {i for i, r in got.items() if r["kept"]} == {i for i, r in got.items() if r["sample_key"] >= keys[20]}


def test_kth_largest(spark):
    rng = random.Random(5)
    values = [rng.choice([0.0, -1e9, 1e-12, rng.gauss(0, 1), 7.5]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 99, 250, 499, 500):
        assert res.kth_largest(df, "v", k) == ordered[k - 1]
    assert res.kth_largest(spark.createDataFrame([(2.0,)] * 9, "v double"), "v", 4) == 2.0


def test_edge_cases(spark):
    docs = frame(spark, [(1, "a b"), (1, "a b"), (None, "c " * 50_000), (2, None)])
    none = spark.createDataFrame([], "doc_id long")
    got = res.importance_sample(docs, none, (1, 1)).collect()
    assert len(got) == 4 and {r["log_weight"] for r in got} == {0.0} and all(r["kept"] for r in got)
    assert not any(r["kept"] for r in res.importance_sample(docs, none, (0, 0)).collect())
    half = res.importance_sample(docs, none, (1, 2)).collect()
    assert len({r["kept"] for r in half if r["doc_id"] == 1}) == 1  # equal rows share one fate
    assert res.importance_sample(docs.limit(0), none, (1, 2)).collect() == []


def test_labelled_target(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (None, 1), (4, None)], "doc_id long, quality int")
    ids, share = res.labelled_target(labels)
    assert sorted(r[0] for r in ids.collect()) == [1, 3] and share == (2, 3)
    assert res.labelled_target(labels, 1)[0].count() == 1
    assert res.labelled_target(labels.limit(0))[1] == (0, 0)
