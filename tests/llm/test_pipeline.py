"""The queries of this package, and the pipeline stage by stage against plain Python."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fundglean.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{FOLDER}/documents.parquet')")
    df = QUERIES[name](spark, FOLDER)
    cursor = con.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    want = sorted(str(tuple(row[names.index(c)] for c in df.columns)) for row in cursor.fetchall())
    assert sorted(str(tuple(r)) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op1_chat_format"}))
def test_one_row_per_document(spark, name):
    got = QUERIES[name](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert sizes[0] > sizes[1] >= sizes[2] == sizes[1] > sizes[3] >= sizes[4] > 0
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
