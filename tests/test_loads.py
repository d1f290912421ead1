import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fundglean import schemas
from fundglean.plans import jobs
from fundglean.sources import loads, tables
from test_tables_and_sources import archive, chunk_rows  # noqa: F401

SPEC = schemas.TEXT_CHUNKS


def numbers(spark, path, **options):
    table = tables.read_table(spark, SPEC, path, **options)
    return None if table is None else sorted(r.chunk_num for r in table.collect())


def rows(spark, *nums):
    return chunk_rows(spark, [("1", "a", n, f"t{n}") for n in nums])


def test_a_failed_load_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_rows(rows(spark, 1, 2), SPEC, path)
    late = rows(spark, *range(10, 50)).repartition(8, "chunk_num")
    bad = late.withColumn("chunk_text", F.when(F.col("chunk_num") != 30, F.col("chunk_text")))
    with pytest.raises(PySparkException):
        tables.append_rows(bad, SPEC, path, load_id="l")
    assert numbers(spark, path) == [1, 2] and loads.snapshots(spark, path) == [1]
    assert tables.append_rows(rows(spark, 3), SPEC, path, load_id="l")
    assert numbers(spark, path) == [1, 2, 3]


def test_a_reader_sees_whole_loads_while_one_is_written(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.append_rows(rows(spark, 1), SPEC, path)
    seen, publish = [], loads.publish

    def watched(*args):
        seen.append(numbers(spark, path))  # all files of the load are there by now
        return publish(*args)

    monkeypatch.setattr(loads, "publish", watched)
    tables.append_rows(rows(spark, 2, 3), SPEC, path)
    assert seen == [[1]] and numbers(spark, path) == [1, 2, 3]


def test_a_load_is_not_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        assert tables.append_rows(rows(spark, 1, 2), SPEC, path, load_id="2024/QTR1 *")
    assert numbers(spark, path) == [1, 2]
    unread = rows(spark, 5).withColumn("chunk_text", F.raise_error(F.lit("read")))
    assert tables.append_rows(unread, SPEC, path, load_id="2024/QTR1 *") is True
    assert tables.append_rows(rows(spark).limit(0), SPEC, path, load_id="none") is False
    assert [(x.id, x.rows) for x in loads.snapshot(spark, path).loads] == [("2024/QTR1 *", 2), ("none", 0)]
    assert numbers(spark, path, only={"none"}) == []


def test_two_writers_of_one_load(spark, tmp_path, monkeypatch):
    """Both write; what the second one publishes after the first leaves one load."""
    path = str(tmp_path / "t")
    publish, nested = loads.publish, []

    def first(*args):
        if not nested:
            nested.append(1)
            tables.append_rows(rows(spark, 1), SPEC, path, load_id="x")
        return publish(*args)

    monkeypatch.setattr(loads, "publish", first)
    tables.append_rows(rows(spark, 1), SPEC, path, load_id="x")
    assert numbers(spark, path) == [1]


def test_writers_at_the_same_time(spark, tmp_path):
    path = str(tmp_path / "t")
    threads = [
        threading.Thread(target=lambda n=n: tables.append_rows(rows(spark, n), SPEC, path, load_id=str(n)))
        for n in range(6)
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert numbers(spark, path) == list(range(6))
    assert loads.snapshots(spark, path) == [1, 2, 3, 4, 5, 6]


def test_earlier_snapshots_stay_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_rows(rows(spark, 1), SPEC, path)
    tables.append_rows(rows(spark, 2), SPEC, path)
    table = tables.read_table(spark, SPEC, path)
    assert tables.replace_rows(table.where("chunk_num = 2"), SPEC, path)  # from the table itself
    assert numbers(spark, path) == [2]
    assert [numbers(spark, path, version=v) for v in loads.snapshots(spark, path)] == [[1], [1, 2], [2]]
    with pytest.raises(ValueError):
        numbers(spark, path, version=9)
    tables.replace_rows(table.limit(0), SPEC, path)
    assert numbers(spark, path) == []


def test_folders_without_snapshots_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_table(spark, SPEC, path) is None
    rows(spark, 4).write.parquet(path)
    assert numbers(spark, path) == [4]


def test_an_index_load_of_one_id_is_loaded_once(spark, archive, tmp_path):  # noqa: F811
    at = jobs.Tables.under(str(tmp_path / "tables"))
    assert jobs.load_index(spark, archive, "2003/1", at, load_id="2003/1") == {(2003, 1): 2}
    assert jobs.load_index(spark, archive, "2003/1", at, load_id="2003/1") == {(2003, 1): 0}
    assert tables.read_table(spark, schemas.MASTER_INDEX, at.full_index).count() == 2
