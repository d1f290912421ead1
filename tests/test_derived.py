import pytest
from pyspark.sql import functions as F

from fundglean import schemas
from fundglean.operators import key_filter, pivots, report, search, token_counts
from fundglean.plans import jobs
from fundglean.sources import derived, tables
from test_relevance import make_search

SPEC = schemas.TEXT_CHUNKS


def chunk_rows(spark, first, end):
    return spark.range(first, end).select(
        (F.col("id") % 5000).cast("string").alias("cik"),
        F.col("id").cast("string").alias("accession_number"),
        F.lit(0).alias("chunk_num"),
        F.lit("t").alias("chunk_text"),
    )


def test_estimates_by_load(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert jobs.estimated_stats(spark, SPEC, path) is None
    read, original = [], tables.read_table
    monkeypatch.setattr(
        derived.tables, "read_table",
        lambda *a, **k: read.append(k["only"]) or original(*a, **k) if k.get("only") else original(*a, **k),
    )
    for n, (first, end) in enumerate([(0, 20_000), (10_000, 50_000), (7, 7)]):
        tables.append_rows(chunk_rows(spark, first, end), SPEC, path, load_id=f"l{n}")
        about = jobs.estimated_stats(spark, SPEC, path).first()
        exact = report.table_stats(original(spark, SPEC, path)).first()
        assert about.total == exact.total
        assert about.cik == pytest.approx(exact.cik, rel=0.02)
        assert about.filings == pytest.approx(exact.filings, rel=0.02)
    jobs.estimated_stats(spark, SPEC, path)
    assert read == [{"l0"}, {"l1"}]  # each load once
    tables.replace_rows(chunk_rows(spark, 0, 100), SPEC, path)
    assert jobs.estimated_stats(spark, SPEC, path).first().total == 100


@pytest.mark.parametrize("lg_bits", [6, 10, 20])
def test_filter_loses_and_keeps_nothing_wrong(spark, lg_bits):
    """A small filter lets more filings be held against the table, with the same result."""
    done = chunk_rows(spark, 0, 600)
    filings = chunk_rows(spark, 300, 1200).select("cik", "accession_number", F.lit(1).alias("more"))
    words = key_filter.merged(key_filter.filter_words(done, lg_bits=lg_bits), lg_bits)
    met = filings.where(key_filter.may_be_done(words, lg_bits)).count()
    assert met >= 300 and (lg_bits < 20 or met == 300)
    got = key_filter.not_done(filings, done, words, lg_bits)
    assert got.columns == filings.columns
    assert sorted(int(r.accession_number) for r in got.collect()) == list(range(600, 1200))


def test_unfinished_filings_by_load(spark, tmp_path):
    path = str(tmp_path / "t")
    filings = chunk_rows(spark, 0, 50).select("cik", "accession_number")
    assert jobs.unfinished(spark, filings, SPEC, path).count() == 50
    tables.append_rows(chunk_rows(spark, 0, 20), SPEC, path)
    assert jobs.unfinished(spark, filings, SPEC, path).count() == 30
    tables.append_rows(chunk_rows(spark, 15, 40), SPEC, path)
    left = jobs.unfinished(spark, filings, SPEC, path).collect()
    assert sorted(int(r.accession_number) for r in left) == list(range(40, 50))


@pytest.mark.parametrize("k, n_pivots", [(7, 5), (1000, 3), (1, 64)])
def test_pivots_give_the_same_rows(spark, k, n_pivots):
    vectors, phrases = make_search(spark)
    odd = spark.createDataFrame([("0", "a", 100, [1.0]), ("0", "a", 101, None), ("9", "a", 0, [1.0] * 6)], vectors.schema)
    short = spark.createDataFrame([("one", [2.0], ["g"])], phrases.schema)
    vectors, phrases = vectors.unionAll(odd), phrases.unionAll(short)
    want = search.top_pairs(vectors, phrases, "g", k).withColumn("distance", F.round("distance", 9))
    got = pivots.top_pairs(vectors, phrases, "g", k, n_pivots, 50).withColumn("distance", F.round("distance", 9))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert pivots.top_pairs(vectors.limit(0), phrases, "g", k).count() == 0


def test_pivots_skip_rings(spark):
    """Groups of near vectors: only the rings about the phrases are scored."""
    def group(n):
        return [10.0 if i == n else 0.1 * ((n * 7 + i) % 3) for i in range(20)]

    rows = [("f", "a", n, [x + 0.01 * (n % 7) for x in group(n % 20)]) for n in range(2000)]
    vectors = spark.createDataFrame(rows, schemas.CHUNK_VECTORS.schema)
    phrases = spark.createDataFrame([("p", group(3), ["g"]), ("q", group(8), ["g"])], schemas.SEARCH_PHRASES.schema)
    share = pivots.scored_share(vectors, phrases, "g", 20, 40).first()
    assert share.n_pairs == 4000 and 40 <= share.n_scored <= 400
    want = search.top_pairs(vectors, phrases, "g", 20).select("chunk_num", "phrase").collect()
    got = pivots.top_pairs(vectors, phrases, "g", 20, 40).select("chunk_num", "phrase").collect()
    assert sorted(got) == sorted(want)


def test_token_counts_of_a_public_tokenizer(spark):
    import base64

    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", "The trustee's fee was $1,000.", "été <|endoftext|> où", "x" * 5000, "a  b\n\n c", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", token_counts.counted_by(P.path("byte_bpe_50k.json"))(F.col("t")).alias("n")).collect()
    want = [None if t is None else len(other.encode_ordinary(t)) for t in texts]
    assert [r.n for r in sorted(got)] == want
