import math
from collections import Counter

import duckdb

from fundglean.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "x") for i, t, s in rows], SCHEMA)


def test_chances_are_poisson(spark):
    for rate in (0.0, 0.2, 1.0, 7.5, 900.0):
        df = spark.createDataFrame([(rate,)], "rate double")
        got = df.select(mixing.cumulative(mixing.F.col("rate"))).first()[0]
        want, p = [], math.exp(-rate) if rate < 700 else None
        if p is None:
            assert abs(got[-1] - 1) < 1e-9 and abs(got[900] - 0.5) < 0.02
            continue
        for k in range(len(got)):
            want.append((want[-1] if want else 0) + p)
            p *= rate / (k + 1)
        assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(got, want, strict=True))


def test_shares_follow_weights(spark):
    """A hot source shrinks and small ones are repeated until their shares fit."""
    rows = [(i, f"t{i}", "hot" if i % 3 else ("a" if i % 2 else None)) for i in range(6000)]
    out = mixing.mix(frame(spark, rows), {"hot": 2.0, "a": 1.0}, other=1.0, epochs=2.0).collect()
    n = Counter(r["source"] for r in out)
    assert abs(len(out) - 12000) < 600
    assert abs(n["hot"] / len(out) - 0.5) < 0.03 and abs(n[None] / len(out) - 0.25) < 0.03
    keys = [r["shuffle_key"] for r in out]
    assert keys == sorted(keys)
    each = Counter((r["doc_id"]) for r in out)
    assert {r["copy"] for r in out if r["doc_id"] == max(each, key=each.get)} == set(range(1, max(each.values()) + 1))


def test_large_means_are_drawn_in_parts(spark):
    """A source of three rows fills half of a mix; counts go on over blocks of copies."""
    rows = [(i, "t", "big") for i in range(30_000)] + [(50_000 + i, "t", "small") for i in range(3)]
    out = mixing.mix(frame(spark, rows))
    n = Counter(r["doc_id"] for r in out.where("source = 'small'").collect())
    assert len(n) == 3 and all(4_600 < v < 5_400 for v in n.values())
    copies = out.where("doc_id = 50000").select("copy").collect()
    assert sorted(r["copy"] for r in copies) == list(range(1, n[50_000] + 1))


def test_many_sources_are_joined_alike(spark, monkeypatch):
    rows = [(i, "t", f"s{i % 7}" if i % 9 else None) for i in range(500)]
    few = sorted(map(str, mixing.mix(frame(spark, rows)).collect()))
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    assert sorted(map(str, mixing.mix(frame(spark, rows)).collect())) == few


def test_edge_cases(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "", None), (2, "x" * 100_000, "a")]
    df = frame(spark, rows)
    out = mixing.mix(df, epochs=50.0)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy", "shuffle_key"]
    n = Counter((r["doc_id"], r["copy"]) for r in out.collect())
    assert set(n[k] for k in n if k[0] == 1) == {2} and n[None, 1] == 1
    assert mixing.mix(df, {"a": 0.0}).where("source = 'a'").count() == 0
    assert mixing.mix(df.limit(0)).collect() == []


def test_sql_twin_with_nulls(spark, tmp_path):
    rows = [(i if i % 11 else None, None if i % 7 == 0 else f"t{i}", f"s{i % 5}" if i % 4 else None) for i in range(300)]
    df = frame(spark, rows).drop("copy")
    df.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    want = con.execute(mixing.sql()).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in mixing.mix(df).collect())
