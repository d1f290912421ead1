"""Each pipeline stage against plain Python, on rows with nulls, ties, copies and clashing names."""

import random
from collections import Counter

import duckdb
import pytest

import corpus_pipeline as cp
from fundglean.llm import mixing, quality_rules
from test_decontaminate import plain as plain_overlaps
from test_line_dedup import plain as plain_lines
from test_simhash import plain_components, plain_fingerprint

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n_deleted string, "
    "verdict string, copy int, shuffle_key string, row_key string"
)


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    rng = random.Random(21)
    vocabulary = [f"{a}{b}" for a in ("fund", "board", "trust", "year", "pay") for b in ("", "s", "ing", "er", "al", "ment")]

    def line():
        return " ".join(rng.choices(vocabulary, k=rng.randint(4, 14))).capitalize() + "."

    shared = "\n".join(line() for _ in range(9))
    item = " ".join(rng.choices(vocabulary, k=25))
    texts = ["\n".join(line() for _ in range(rng.randint(1, 12))) for _ in range(60)]
    texts += [f"{line()}\n{shared}\n{line()}" for _ in range(4)]
    texts += [f"{line()} {item} {line()}\n{line()}\n{line()}" for _ in range(3)]
    texts += [texts[5], texts[6], texts[7] + " more", None, "", " \n ", "!!! ### $$$ " * 40, "same words here " * 30]
    rows = [(i, t, "en", rng.choice(["a", "a", "a", "b", None]), None if t is None else len(t), "x", "y", 7, "z", "k")
            for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, *rows[4][1:]), (None, *rows[4][1:]), (9, *rows[10][1:])]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = [(i, 0 if t is None or "###" in t else 1, 0) for i, t in enumerate(texts)][:70] + [(77, 0, 0), (None, 1, 0), (3, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    items = [(1, item), (1, item), (2, None), (None, "quite another item of words that is nowhere")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return docs, str(folder), item


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def staged(spark, world, upto, tmp_path):
    """The input of a stage: what those before it kept, written and read again."""
    docs, folder, _ = world
    for n, (_, stage) in enumerate(cp.STAGES[:upto]):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
    return docs


def test_quality_rules(spark, world):
    docs, folder, _ = world
    out = cp.quality_rules(spark, docs, folder)
    assert out.columns == docs.columns
    field = quality_rules.fit(quality_rules.sample(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    kept = [r for r in rows_of(docs) if quality_rules.judge(None if r[1] is None else r[1].encode(), field, 0.5)[-1]]
    assert Counter(rows_of(out)) == Counter(kept)
    assert 30 < len(kept) < docs.count() and all(len(r[1].split()) >= 20 for r in kept)


def test_line_dedup(spark, world):
    docs, folder, _ = world
    out = cp.dedup_lines(spark, docs, folder)
    assert out.columns == docs.columns
    given = rows_of(docs)
    left = plain_lines([(r[0], r[1]) for r in given], 50)
    want = []
    for r in given:
        text = left[r[0], r[1]]
        want.append((r[0], text, r[2], r[3], r[4] if text == r[1] else len(text), *r[5:]))
    assert Counter(rows_of(out)) == Counter(want)
    assert sum(a != b[1] for a, b in zip((r[1] for r in want), given, strict=True)) >= 4


def test_near_dedup(spark, world):
    docs, folder, _ = world
    out = rows_of(cp.dedup_near(spark, docs, folder))
    given = rows_of(docs)
    prints = sorted({plain_fingerprint(r[1]) for r in given})
    group = dict(zip(prints, plain_components(prints), strict=True))
    best = {}
    for r in given:
        own = group[plain_fingerprint(r[1])]
        best[own] = min(best.get(own, (True, 0)), (r[0] is None, r[0] or 0))
    got = [(r[0] is None, r[0] or 0) for r in out]
    assert sorted(got) == sorted(best.values()) and set(out) <= set(given)


def test_decontamination(spark, world):
    docs, folder, item = world
    out = cp.drop_benchmark(spark, docs, folder)
    assert out.columns == docs.columns
    items = [(1, item), (3, "quite another item of words that is nowhere")]
    kept = [r for r in rows_of(docs) if not plain_overlaps(r[1], items)]
    assert Counter(rows_of(out)) == Counter(kept) and len(kept) == docs.count() - 3


def test_mixing(spark, world, tmp_path):
    docs, folder, _ = world
    out = cp.mix_sources(spark, docs, folder)
    con = duckdb.connect()
    standard = docs.select("doc_id", "text", "lang", "source", "n_chars")
    standard.write.parquet(str(tmp_path / "documents.parquet"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cursor = con.execute(mixing.sql())
    names = [c[0] for c in cursor.description]
    assert Counter(map(str, cursor.fetchall())) == Counter(str(tuple(r)) for r in out.select(*names).collect())


def test_all_stages_in_turn(spark, world, tmp_path):
    """Each stage works on what the one before it kept; decisions take effect."""
    docs = staged(spark, world, 4, tmp_path)
    assert docs.columns == world[0].columns
    left = docs.collect()
    prints = sorted(plain_fingerprint(r["text"]) for r in spark.read.parquet(str(tmp_path / "2")).collect())
    assert len(set(plain_components(prints))) == len(prints)
    assert not any(plain_overlaps(r["text"], [(1, world[2])]) for r in left)
    assert 0 < len(left) < world[0].count()
