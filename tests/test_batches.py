import random

import pytest
from pyspark.sql import functions as F

from fundglean.operators import batches, calls


def expected(sizes, max_tokens, max_chunks):
    ids, batch, used, count = [], -1, 0, 0
    for size in sizes:
        if batch < 0 or count >= max_chunks or used + size > max_tokens:
            batch, used, count = batch + 1, 0, 0
        used, count = used + size, count + 1
        ids.append(batch)
    return ids


def filings(seed, lengths):
    rng = random.Random(seed)
    return {
        str(i): [rng.choice([0, 1, 5, 9, 30, 200]) for _ in range(n)]
        for i, n in enumerate(lengths)
    }


def frame(spark, data):
    rows = [(f, "a", 3 * n, t) for f, sizes in data.items() for n, t in enumerate(sizes)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(
        rows, "cik string, accession_number string, chunk_num int, tokens int"
    )


def ids(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.cik, r.chunk_num)):
        out.setdefault(r.cik, []).append(r.batch_id)
    return out


@pytest.mark.parametrize("max_tokens, max_chunks", [(100, 4), (60, 7), (10_000, 3), (1, 7)])
def test_long_filings_give_the_same_batches(spark, max_tokens, max_chunks):
    """Segments (of 7 here) against the fold within a row and a plain loop."""
    data = filings(11, [1, 6, 7, 8, 14, 15, 100, 57])
    df = frame(spark, data)
    want = {f: expected(s, max_tokens, max_chunks) for f, s in data.items()}
    assert ids(batches._in_one_row(df, max_tokens, max_chunks)) == want
    assert ids(batches._by_segments(df, max_tokens, max_chunks, segment=7)) == want


def test_only_long_filings_are_cut(spark):
    data = filings(2, [3, 40])
    got = batches.token_batches(frame(spark, data), F.col("tokens"), 50, 5, fold_limit=10)
    assert ids(got) == {f: expected(s, 50, 5) for f, s in data.items()}


def test_unknown_token_counts_are_zero(spark):
    data = {"0": [5, None, 5, 5, None, None, 9], "1": [None] * 12}
    df = frame(spark, data)
    want = {f: expected([t or 0 for t in s], 9, 4) for f, s in data.items()}
    for limit in (3, 100):  # by segments and within a row
        assert ids(batches.token_batches(df, F.col("tokens"), 9, 4, fold_limit=limit)) == want


def test_requests_hold_texts_in_order(spark):
    data = filings(5, [1, 9, 30])
    df = frame(spark, data).withColumn("t", F.concat_ws("/", "cik", "chunk_num"))
    rows = batches.requests(df, "t", F.col("tokens"), 40, 3).collect()
    for cik, sizes in data.items():
        own = sorted((r for r in rows if r.cik == cik), key=lambda r: r.batch_id)
        want = expected(sizes, 40, 3)
        assert [r.batch_id for r in own for _ in r["items"]] == want
        assert [i.text for r in own for i in r["items"]] == [f"{cik}/{3 * n}" for n in range(len(sizes))]


def test_copies_of_a_chunk_are_each_sent(spark):
    rows = [("1", "a", n, f"t{n}", 4) for n in (0, 0, 0, 1, 2, 2)] + [("1", "a", 2, "other", 4), ("1", "a", 3, None, 0)]
    df = spark.createDataFrame(rows, "cik string, accession_number string, chunk_num int, t string, tokens int")
    got = sorted(batches.requests(df, "t", F.col("tokens"), 9, 2).collect(), key=lambda r: r.batch_id)
    items = [(i.chunk_num, i.text) for r in got for i in r["items"]]
    assert sorted(items, key=str) == sorted([(r[2], r[3]) for r in rows], key=str)
    assert [n for n, _ in items] == sorted(n for n, _ in items) and all(len(r["items"]) <= 2 for r in got)


def test_a_filing_of_sixty_thousand_chunks(spark):
    """Texts stay out of the fold: no row holds more than a request's."""
    n = 60_000
    chunks = spark.range(n).select(
        F.lit("1").alias("cik"), F.lit("a").alias("accession_number"), F.col("id").cast("int").alias("chunk_num"),
        F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 50)).alias("t"),
    )
    sizes = F.pmod("chunk_num", F.lit(7)) + 1
    got = batches.requests(chunks, "t", sizes, 40, 9)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert all("text#" not in line for line in plan.split("\n") if "collect_list(struct(chunk_num" in line and "tokens" in line)
    rows = got.select("batch_id", F.col("items.chunk_num").alias("n"), F.size("items").alias("size")).collect()
    want = expected([i % 7 + 1 for i in range(n)], 40, 9)
    assert {(i, r.batch_id) for r in rows for i in r.n} == set(enumerate(want))
    assert max(r.size for r in rows) <= 9


def test_vectors_of_few_requests_are_python_values_at_a_time(spark):
    """A worker holds texts and vectors of a batch as Arrow, not as Python lists."""

    def traced(texts):
        import tracemalloc

        import pandas  # noqa: F401  what Arrow loads itself is not counted

        if not tracemalloc.is_tracing():
            tracemalloc.start()
        held = tracemalloc.get_traced_memory()[0]
        return [[float(held)] + [i + 0.5 for i in range(500)] for _ in texts]

    rows = spark.range(0, 2000, 1, 1).select(F.array(F.col("id").cast("string")).alias("texts"))
    vectors = rows.select(calls.embedded(F.col("texts"), traced).alias("v")).select("v", F.col("v")[0][0].alias("held"))
    about = vectors.agg(F.max("held").alias("held"), F.count("v").alias("n"), F.max(F.size(F.col("v")[0])).alias("size")).first()
    assert (about.n, about.size) == (2000, 501)
    assert about.held < 4_000_000  # 32 MB as lists
