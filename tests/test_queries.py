"""Every registered query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def canonical(rows):
    return sorted(
        tuple(repr(round(x, 6) if isinstance(x, float) else x) for x in row) for row in rows
    )


def test_every_query_has_a_twin():
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert without <= set(entry.training_data()[0])


@pytest.mark.parametrize("name", sorted(entry.ORACLES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    want = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    assert canonical(got) == canonical(want)


def test_flagship(spark):
    assert len(entry.entry(spark).head(1)) == 1
