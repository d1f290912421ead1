import glob
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fundglean import schemas
from fundglean.operators import filters, report, sampling, tickers
from fundglean.plans import jobs
from fundglean.operators.spreading import spread
from fundglean.sources import filings, fund_lists, index_files, tables

HEADER = "".join(f"header line {i}\n" for i in range(9)) + "CIK|Name|Form|Date|File\n" + "-" * 30 + "\n"


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))


@pytest.fixture
def archive(tmp_path):
    root = tmp_path / "edgar"
    write(
        root / "full-index/2003/QTR1/master.idx",
        HEADER
        + '100|"Q" FUND|485BPOS|2003-02-01|edgar/data/100/0001-03-1.txt\n'
        + "200|OTHER|485bpos|2003-02-02|edgar/data/200/0001-03-2.txt\n"
        + "300|THIRD|10-K|2003-02-03|edgar/data/300/0001-03-3.txt\n"
        + "400|EMPTY||2003-02-03|edgar/data/400/0001-03-4.txt\n",
    )
    write(
        root / "full-index/2004/QTR2/master.idx",
        HEADER.encode() + b"100|B\xffAD|485BPOS|2004-05-01|edgar/data/100/0001-04-1.txt\n",
    )
    write(root / "full-index/2004/QTR3/master.idx", HEADER)
    return str(tmp_path)


def test_index_files(spark, archive):
    rows = index_files.read_master_index(spark, archive, "200[34]/*", "485BPOS")
    got = {r.accession_number: (r.cik, r.company_name, r.year, r.quarter) for r in rows.collect()}
    assert got == {
        "0001-03-1": ("100", '"Q" FUND', 2003, 1),
        "0001-03-2": ("200", "OTHER", 2003, 1),
        "0001-04-1": ("100", "B�AD", 2004, 2),
    }
    assert all(r.tags is None for r in rows.collect())
    counts = {tuple(r) for r in jobs.index_counts(spark, archive, "200?/*").collect()}
    assert counts == {(2003, 1, 2), (2004, 2, 1)}
    everything = index_files.read_master_index(spark, archive, "2003/1")
    assert everything.count() == 3  # a row without a form type is dropped
    with pytest.raises(ValueError):
        index_files.quarter_glob(spark, archive, "1901/*")
    with pytest.raises(ValueError):
        index_files.quarter_glob(spark, archive, "2003/4")


def test_quarters_are_those_there(spark, archive, tmp_path):
    """Any year loads; a gap among the wanted quarters is reported."""
    for name in ("2025/QTR1", "1993/QTR4"):
        write(tmp_path / "edgar/full-index" / name / "master.idx", HEADER + f"1|N|10-K|{name[:4]}-01-02|edgar/data/1/a.txt\n")
    with pytest.warns(UserWarning, match="2004/4.*"):
        rows = index_files.read_master_index(spark, archive, "*")
    years = {r.year for r in rows.collect()}
    assert {1993, 2025} <= years
    assert index_files.read_master_index(spark, archive, "2025/*").count() == 1
    assert index_files.wanted_quarters([(2003, 1), (2003, 4)], "2003/[14]") == ([(2003, 1), (2003, 4)], [])
    assert index_files.wanted_quarters([(2003, 1), (2003, 4)], "2003/?")[1] == [(2003, 2), (2003, 3)]


def sgml(documents, date="20240429", header=True):
    head = f"<SEC-HEADER>x.hdr.sgml\nFILED AS OF DATE:\t\t{date}\n</SEC-HEADER>\n" if header else ""
    docs = "".join(
        f"<DOCUMENT>\n<TYPE>{t}\n<SEQUENCE>{i + 1}\n<FILENAME>{f}\n"
        + ("<DESCRIPTION>D &amp; E\n" if i else "")
        + f"<TEXT>\n<a href='{f}'>Document {i + 1} - file: {f}</a>\n</DOCUMENT>\n"
        for i, (t, f) in enumerate(documents)
    )
    escaped = (head + docs).replace("<", "&lt;").replace(">", "&gt;")
    return f"<HTML><HEAD><!-- <SEC-HEADER> --></HEAD><BODY>\n<PRE>{escaped}</PRE></BODY></HTML>"


def page_folder(root, cik, accession):
    return root / "edgar/data" / cik / accession.replace("-", "")


def test_manifest_and_contents(spark, tmp_path):
    one, two, three = "0001-24-1", "0001-24-2", "0001-24-3"
    write(
        page_folder(tmp_path, "100", one) / f"{one}-index-headers.html",
        sgml([("485BPOS", "main.htm"), ("EX-99", "ex.htm"), ("GRAPHIC", "g.jpg")]),
    )
    write(page_folder(tmp_path, "100", one) / "main.htm", "<p>hello</p>")
    write(
        page_folder(tmp_path, "200", two) / f"{two}-index-headers.html",
        sgml([("485BPOS", "a.htm"), ("485BPOS", "b.htm")]),
    )
    write(
        page_folder(tmp_path, "300", three) / f"{three}-index-headers.html",
        sgml([("485BPOS", "a.htm")], header=False),
    )
    pages = filings.read_pages(spark, str(tmp_path / "edgar/data/*/*/*-index-headers.html"))
    headers = filings.filing_headers(filings.keyed_headers_pages(pages))
    dates = {r.cik: r.date_filed and str(r.date_filed) for r in headers.collect()}
    assert dates == {"100": "2024-04-29", "200": "2024-04-29", "300": None}
    manifest = filings.manifest(headers)
    got = {(r.accession_number, r.sequence, r.type, r.filename) for r in manifest.collect()}
    assert got == {
        (one, 1, "485BPOS", "main.htm"), (one, 2, "EX-99", "ex.htm"), (one, 3, "GRAPHIC", "g.jpg"),
        (two, 1, "485BPOS", "a.htm"), (two, 2, "485BPOS", "b.htm"),
    }
    chosen = filters.document_of_type(manifest, "EX-99")
    assert {(r.cik, r.filename, r.status) for r in chosen.collect()} == {
        ("100", "ex.htm", "ok"), ("200", None, "missing"),
    }
    both = filters.document_of_type(manifest, "485BPOS").where("cik = '200'").first()
    assert (both.filename, both.status) == (None, "ambiguous")
    contents = filings.with_contents(
        manifest.where("type != 'GRAPHIC'"),
        filings.read_pages(spark, str(tmp_path / "edgar/data/*/*/*.htm")),
    )
    assert {r.filename: r.content for r in contents.where("cik = '100'").collect()} == {
        "main.htm": "<p>hello</p>", "ex.htm": None,
    }


def test_ticker_files(spark, tmp_path):
    data = {
        "fields": ["cik", "seriesId", "symbol"],
        "data": [[1, "S1", "abc "], [2, "S2", "LONGX"], [3, "S3", "ABC"]],
    }
    write(tmp_path / "map.json", json.dumps(data, indent=1))
    write(tmp_path / "list.csv", "abc,Fund A\nlongx ,Fund B\nNOPE,Fund C\nxy,Fund D\nABC,again\n")
    jobs.map_tickers(
        spark, str(tmp_path / "map.json"), str(tmp_path / "list.csv"), str(tmp_path / "out")
    )
    lines = [x for f in glob.glob(f"{tmp_path}/out/part-*") for x in open(f).read().split()]
    assert sorted(lines) == ["ABC,3", "LONGX,2", "NOPE,XXXX"]
    rows = fund_lists.read_columnar_json(spark, str(tmp_path / "map.json"), ["symbol", "none"])
    assert {(r.ordinal, r.symbol, r.none) for r in rows.collect()} == {
        (0, "abc ", None), (1, "LONGX", None), (2, "ABC", None),
    }


def chunk_rows(spark, rows):
    return spark.createDataFrame(rows, "cik string, accession_number string, chunk_num int, chunk_text string")


def test_append_and_lookup(spark, tmp_path):
    path = str(tmp_path / "filing_text_chunks")
    assert tables.read_table(spark, schemas.TEXT_CHUNKS, path) is None
    rows = chunk_rows(spark, [("1", "a", n, f"sentence {n}") for n in range(5)])
    assert tables.append_rows(rows, schemas.TEXT_CHUNKS, path) is True
    assert tables.append_rows(rows.where("false"), schemas.TEXT_CHUNKS, path) is False
    table = tables.read_table(spark, schemas.TEXT_CHUNKS, path)
    assert [r.chunk_num for r in filters.chunks_of(table, "1", "a").collect()] == [0, 1, 2, 3, 4]
    some = filters.chunks_of(table, "1", "a", [3, 1]).collect()
    assert [r.chunk_text for r in some] == ["sentence 1", "sentence 3"]
    asked = spark.createDataFrame(
        [("1", "a", [1, 3]), ("2", "a", [])],
        "cik string, accession_number string, chunk_nums array<int>",
    )
    assert sorted(r.chunk_num for r in filters.requested_chunks(table, asked).collect()) == [1, 3]


@pytest.mark.parametrize(
    "row", [("1", "a", 0, None), (None, "a", 0, "t"), ("12345678901", "a", 0, "t")]
)
def test_bad_rows_fail_the_write(spark, tmp_path, row):
    with pytest.raises(PySparkException):
        tables.append_rows(chunk_rows(spark, [row]), schemas.TEXT_CHUNKS, str(tmp_path / "t"))


def test_vector_size_is_checked(spark, tmp_path):
    rows = spark.createDataFrame(
        [("1", "a", 0, [0.1, 0.2])], schemas.CHUNK_VECTORS.schema
    )
    path = str(tmp_path / "v")
    assert tables.append_rows(rows, schemas.CHUNK_VECTORS, path, dimension=2)
    with pytest.raises(PySparkException):
        tables.append_rows(rows, schemas.CHUNK_VECTORS, path, dimension=3)


def phrase_rows(spark, rows):
    return spark.createDataFrame(
        [(p, [1.0, 0.0], t) for p, t in rows], schemas.SEARCH_PHRASES.schema
    )


def test_phrases_of_exactly_one_tag_are_replaced(spark, tmp_path):
    path = str(tmp_path / "search")
    first = [("a", ["g"]), ("b", ["g"]), ("c", ["g", "h"]), ("d", None), ("e", ["h"])]
    tables.replace_phrases(phrase_rows(spark, first), path)
    tables.replace_phrases(phrase_rows(spark, [("new", ["g"])]), path, dimension=2)
    table = tables.read_table(spark, schemas.SEARCH_PHRASES, path)
    assert sorted(r.phrase for r in table.collect()) == ["c", "d", "e", "new"]
    assert sorted(r.phrase for r in filters.with_tag(table, "g").collect()) == ["c", "new"]
    left = filters.without_exact_tag(phrase_rows(spark, first), "g")
    assert sorted(r.phrase for r in left.collect()) == ["c", "d", "e"]


def index_rows(spark, rows):
    return spark.createDataFrame(
        rows,
        "cik string, company_name string, form_type string, date_filed string, "
        "idx_filename string, accession_number string, tags array<string>",
    ).withColumn("date_filed", F.col("date_filed").cast("date"))


def test_export_of_repeated_loads(spark, tmp_path):
    one = ("1", "A", "485BPOS", "2003-01-02", "f1", "a1", ["t"])
    two = ("2", "B", "485BPOS", "2003-01-03", "f2", "a2", ["t"])
    index = index_rows(spark, [one] * 20 + [two] * 20 + [("3", "C", "x", "2003-01-03", "f", "a", None)])
    results = spark.createDataFrame(
        [("1", "a1", [1, 2], "text", "{}", 2, ["r"])] * 20
        + [("2", "a2", [1], "text", "", 0, ["other"]), ("2", "a2", [1], "text", "", 0, None)],
        "cik string, accession_number string, selected_chunks array<int>, selected_text string, "
        "response string, n_trustee int, tags array<string>",
    )
    tables.write_json_lines(report.export_rows(index, results, "t", "r"), str(tmp_path / "out"))
    lines = [
        json.loads(x) for f in glob.glob(f"{tmp_path}/out/part-*") for x in open(f).readlines()
    ]
    lines.sort(key=lambda x: x["cik"])
    assert len(lines) == 2
    assert lines[0]["chunks_used"] == [1, 2] and lines[0]["date_filed"] == "2003-01-02"
    assert lines[1]["chunks_used"] is None and "num_trustees" in lines[1]
    assert report.export_rows(index, results, "t", "r", limit=1).first().cik == "1"


@pytest.mark.parametrize("n", [0, 1, 10, 11, 997])
def test_sample_size_is_exact_and_repeatable(spark, n):
    index = index_rows(
        spark, [(str(i), "A", "f", "2002-06-01", "p", f"a{i}", None) for i in range(n)] * 2
    ) if n else index_rows(spark, [("x", "A", "f", "1999-01-01", "p", "a", None)])
    funds = spark.range(n + 5).select(F.col("id").cast("string").alias("cik"))
    draw = lambda seed: sorted(
        r.cik for r in sampling.sample_ciks(index, funds, "2002-01-01", "2004-12-31", seed).collect()
    )
    first = draw("s")
    assert len(first) == len(set(first)) == -(-n // 10)
    assert draw("s") == first
    if n > 100:
        assert draw("other") != first


def test_last_symbol_wins(spark):
    mapping = spark.createDataFrame(
        [("AAAA", "1", 0), (" aaaa", "2", 1)], "symbol string, cik string, ordinal int"
    )
    asked = spark.createDataFrame([("aaaa ",), ("bbb",), ("bbbb",)], "ticker string")
    got = {tuple(r) for r in tickers.lookup_tickers(mapping, asked).collect()}
    assert got == {("AAAA", "2"), ("BBBB", "XXXX")}


def test_no_rows_leave_no_file(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("1", "a", 0, "x")], schemas.TEXT_CHUNKS.schema)
    for _ in range(2):
        assert tables.append_rows(rows.limit(0), schemas.TEXT_CHUNKS, path) is False
    assert glob.glob(f"{path}/**/*.parquet", recursive=True) == []
    assert tables.append_rows(rows, schemas.TEXT_CHUNKS, path) is True
    assert tables.read_table(spark, schemas.TEXT_CHUNKS, path).collect() == rows.collect()


def test_index_is_laid_out_by_quarter(spark, archive, tmp_path):
    at = jobs.Tables.under(str(tmp_path / "tables"))
    assert jobs.load_index(spark, archive, "200?/*", at) == {(2003, 1): 2, (2004, 2): 1, (2004, 3): 0}
    plan = jobs._index_between(spark, at, ("2004-01-01", "2004-12-31"))
    assert "PartitionFilters: [isnotnull(year" in plan._jdf.queryExecution().executedPlan().toString()
    assert [r.accession_number for r in plan.collect()] == ["0001-04-1"]


def test_a_headers_page_is_looked_through_once(spark):
    """The block of a page is found once, and its text decoded once, for all that is read from it."""
    rows = [("edgar/data/1/2-3/2-3-index-headers.html", "<PRE>&lt;SEC-HEADER&gt;\n</PRE>")]
    pages = spark.createDataFrame(rows, "path string, content string")
    headers = filings.filing_headers(filings.keyed_headers_pages(pages))
    plan = headers._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(content") == 1
    assert [(r.cik, r.accession_number, r.folder, r.documents) for r in headers.collect()] == [
        ("1", "2-3", "edgar/data/1/2-3", [])
    ]


def test_few_more_splits_than_slots_are_dealt_out_again(spark):
    slots = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 1000, 1, slots + 1)
    assert spread(rows, "id").rdd.getNumPartitions() == slots + 1
    assert spread(rows, "id", waves=2).rdd.getNumPartitions() == 2 * slots
    many = spark.range(0, 1000, 1, 2 * slots)
    assert "Exchange" not in spread(many, "id", waves=2)._jdf.queryExecution().executedPlan().toString()
