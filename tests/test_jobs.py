import json
import glob

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fundglean import schemas
from fundglean.plans import jobs
from fundglean.plans.jobs import Tables
from fundglean.sources import filings as filing_files
from fundglean.sources import tables
from test_tables_and_sources import HEADER, page_folder, sgml, write

TABLE = "".join(
    f"<tr><td>Trustee Number {i}</td><td>{i},000</td><td>Aggregate Compensation</td></tr>"
    for i in range(12)
)


def sentences(word, n):
    return " ".join(f"The {word} of the fund number {i} is described here at some length." for i in range(n))


@pytest.fixture
def world(spark, tmp_path):
    root = tmp_path / "archive"
    lines = [HEADER]
    for n in range(20):
        cik, accession = str(100 + n), f"0001-03-{n}"
        lines.append(f"{cik}|Fund {n}|485BPOS|2003-03-0{n % 9 + 1}|edgar/data/{cik}/{accession}.txt\n")
        folder = page_folder(root, cik, accession)
        main = "main.txt" if n == 3 else "main.htm"
        write(folder / f"{accession}-index-headers.html", sgml([("485BPOS", main), ("EX-99", "ex.htm")]))
        page = (
            f"<html><body><div style='display:none'>{sentences('secret', 50)}</div>"
            f"<p>{sentences('strategy', 60)}</p><p>{sentences('risk', 60)}</p>"
            f"<h2>Trustee Compensation</h2><p>{sentences('trustee compensation table', 3)}</p>"
            f"<table>{TABLE}</table><p>{sentences('holding', 60)}</p></body></html>"
        )
        write(folder / main, "<p>short</p>" if n == 4 else page)
        write(folder / "ex.htm", "<p>exhibit</p>")
    write(root / "edgar/full-index/2003/QTR1/master.idx", "".join(lines))
    return spark, str(root), Tables.under(str(tmp_path / "tables"))


def make_answer():
    def answers(prompts):
        return [answer(p) for p in prompts]

    def answer(prompt):
        names = [f"Trustee Number {i}" for i in range(12) if f"Trustee Number {i} |" in prompt]
        body = {"compensation_info_present": bool(names), "trustees": [{"name": n} for n in names]}
        return "```json\n" + json.dumps(body) + "\n```"

    return answers


def test_from_index_files_to_export(world, tmp_path):
    spark, archive, at = world
    assert jobs.load_index(spark, archive, "2003/*", at) == {(2003, 1): 20}
    assert jobs.ingest_pages(spark, archive, at) and not jobs.ingest_pages(spark, archive, at)
    funds = spark.range(100, 120).select(F.col("id").cast("string").alias("cik"))
    assert jobs.sample(
        spark, at, funds, draw_range=("2003-01-01", "2003-12-31"), keep_range=("2003-01-01", "2003-12-31")
    )
    assert spark.read.parquet(at.index).count() == 2
    # the whole of the loaded filings from here on
    everything = Tables(**{**at.__dict__, "index": at.index + "_all"})
    rows = spark.read.parquet(at.full_index).withColumn("tags", F.array(F.lit("all")))
    rows.write.parquet(everything.index)

    assert jobs.chunk(spark, everything, "all", size=1000)
    chunks = spark.read.parquet(everything.text)
    ciks = {r.cik for r in chunks.select("cik").distinct().collect()}
    assert ciks == {str(100 + n) for n in range(20)} - {"103", "104"}
    assert chunks.where(F.contains("chunk_text", F.lit("secret"))).count() == 0
    whole = chunks.where("cik = '100'").orderBy("chunk_num").collect()
    assert [r.chunk_num for r in whole] == list(range(len(whole)))
    assert sum("Trustee Number 0 | 0,000" in r.chunk_text and "Trustee Number 11 |" in r.chunk_text for r in whole) == 1
    files = sorted(glob.glob(f"{everything.text}/**/*.parquet", recursive=True))
    assert jobs.chunk(spark, everything, "all", size=1000) is False  # nothing left to do
    assert sorted(glob.glob(f"{everything.text}/**/*.parquet", recursive=True)) == files
    settled = {r.cik: (r.status, r.n_chunks) for r in spark.read.parquet(at.outcomes).collect()}
    assert settled.pop("103") == ("not_html", 0) and settled.pop("104") == ("single", 0)
    assert {s for s, _ in settled.values()} == {"ok"} and settled["100"][1] == len(whole)

    assert jobs.embedding(spark, everything, "all", dimension=256)
    assert jobs.embedding(spark, everything, "all", dimension=256) is False
    assert spark.read.parquet(everything.embedding).count() == chunks.count()
    for _ in range(2):
        jobs.init_search_phrases(spark, everything, "group1", dimension=256)
    assert spark.read.parquet(everything.search).count() == 4

    assert jobs.extract(spark, everything, "all", "group1", "batch1", "some-model", make_answer())
    results = spark.read.parquet(everything.result)
    assert results.count() == 18
    assert {r.n_trustee for r in results.collect()} == {12}
    assert results.first().comp_info.trustees[0].name == "Trustee Number 0"

    jobs.export(spark, everything, "all", "batch1", str(tmp_path / "out"))
    lines = [json.loads(x) for f in glob.glob(f"{tmp_path}/out/part-*") for x in open(f)]
    assert len(lines) == 20
    assert sum(x["num_trustees"] is None for x in lines) == 2
    numbers = {k: v.first().asDict() for k, v in jobs.statistics(spark, everything, "batch1").items()}
    assert numbers["master_idx_sample"] == {"count": 20}
    assert numbers["filing_text_chunks"]["filings"] == 18
    assert numbers["results_by_filing"] == {"total": 18, "accepted": 18, "not_accepted": 0}
    assert numbers["results_by_company"] == {"total": 18, "extracted": 18, "failed": 0}


def test_skipped_model_calls_store_the_last_try(world):
    spark, archive, at = world
    jobs.load_index(spark, archive, "2003/1", at)
    jobs.ingest_pages(spark, archive, at)
    rows = spark.read.parquet(at.full_index).withColumn("tags", F.array(F.lit("all")))
    rows.write.parquet(at.index)
    assert jobs.chunk(spark, at, "all", batch_limit=2, size=1000)
    embed = lambda texts: [[float(len(t) % 7), float(len(t)), 1.0] for t in texts]
    assert jobs.embedding(spark, at, "all", embed, dimension=3)
    jobs.init_search_phrases(spark, at, "g", embed, dimension=3)
    assert jobs.extract(spark, at, "all", "g", "dry", "none")
    results = spark.read.parquet(at.result).collect()
    assert len(results) == 2
    assert {(r.n_trustee, r.response) for r in results} == {(0, "")}
    assert all(len(r.selected_chunks) > 0 and len(r.selected_text) >= 100 for r in results)


def test_only_wanted_pages_are_read(world):
    """Kind and bucket of the wanted filings reach the scan as partition filters."""
    spark, archive, at = world
    jobs.ingest_pages(spark, archive, at)
    one = spark.createDataFrame([("100", "0001-03-0")], "cik string, accession_number string")
    pages = jobs.pages_of(spark, at, one, "document")
    plan = pages._jdf.queryExecution().executedPlan().toString()
    filters_ = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "kind" in filters_ and "bucket" in filters_
    assert {r.path.split("/")[2] for r in pages.collect()} >= {"100"}
    assert pages.count() < 40


def rows_scanned(df):
    """Rows that the scans of the plan gave out, run whole."""
    executed = df._jdf.queryExecution()
    executed.toRdd().count()
    leaves = executed.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_row_groups_without_a_wanted_filing_are_skipped(spark, tmp_path):
    """A thousand filings over all buckets, of fifty companies; most others are not read."""
    path = F.format_string("edgar/data/%d/%d/p.htm", F.col("id") % 1000, F.col("id"))
    pages = spark.range(20_000).select(path.alias("path"), F.repeat(F.lit("x"), 50).alias("content"))
    table = str(tmp_path / "pages")
    tables.append_rows(filing_files.laid_out(pages), schemas.PAGES, table)
    wanted = spark.range(20_000).where("id % 1000 < 50").select(
        (F.col("id") % 1000).cast("string").alias("cik"), F.col("id").cast("string").alias("accession_number")
    )
    written = tables.read_table(spark, schemas.PAGES, table, layout=True)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with filing_files.pushing_keys(spark):
            found = filing_files.pages_of_filings(written, wanted, "document").select("filing", "content")
            scanned = rows_scanned(found)
        assert found.count() == 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert written.select("bucket").distinct().count() == filing_files.PAGE_BUCKETS
    assert 1000 <= scanned < 8000


def test_known_pages_are_not_read_again(world, monkeypatch):
    spark, archive, at = world
    read = []
    original = filing_files.read_pages
    monkeypatch.setattr(
        filing_files, "read_pages", lambda spark, *paths: read.append(len(paths)) or original(spark, *paths)
    )
    assert jobs.ingest_pages(spark, archive, at, ciks="10[0-4]") and read == [14]
    monkeypatch.setattr(filing_files, "PATHS_PER_READ", 40)
    assert jobs.ingest_pages(spark, archive, at) and read == [14, 40, 5]
    assert not jobs.ingest_pages(spark, archive, at) and len(read) == 3
    pages = tables.read_table(spark, schemas.PAGES, at.pages)
    assert pages.count() == pages.select("path").distinct().count() == 59
    listed = filing_files.list_pages(spark, f"{archive}/edgar/data/*/*/*.htm*")
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_settled_filings_can_be_tried_again(world):
    spark, archive, at = world
    jobs.load_index(spark, archive, "2003/1", at)
    rows = spark.read.parquet(at.full_index).withColumn("tags", F.array(F.lit("all")))
    rows.where("cik in ('100', '105')").write.parquet(at.index)
    jobs.ingest_pages(spark, archive, at, ciks="100")
    assert jobs.chunk(spark, at, "all", size=1000)
    last = lambda: {r.cik: r.status for r in spark.read.parquet(at.outcomes).orderBy("loaded").collect()}
    assert last() == {"100": "ok", "105": "missing"}
    jobs.ingest_pages(spark, archive, at, ciks="105")
    assert jobs.chunk(spark, at, "all", size=1000) is False
    assert jobs.chunk(spark, at, "all", size=1000, retry=["missing"])
    assert last() == {"100": "ok", "105": "ok"}


def test_filings_of_one_page_share_its_chunks(spark):
    """Chunks told by path are counted once and hold for every filing of that document."""
    documents = spark.createDataFrame(
        [(1, "ok", "p.htm", "p"), (2, "ok", "p.htm", "p"), (3, "ok", "q.htm", "q"), (4, "missing", None, "")],
        "filing long, status string, filename string, path string",
    )
    pages = spark.createDataFrame([("p", 9), ("q", 9)], "path string, n_chars long")
    chunks = spark.createDataFrame([("p", 0), ("p", 1)], "path string, chunk_num int")
    rows = jobs.outcomes(documents, pages, chunks, ["filing"], ["path"]).collect()
    assert sorted(map(tuple, rows)) == [(1, "ok", 2), (2, "ok", 2), (3, "single", 0), (4, "missing", 0)]


def test_a_page_of_many_filings_is_chunked_once(spark, tmp_path):
    """Orders of one part name one page, whose chunks are made in a single row."""
    lines = [(order, 1, 0, 1, "A") for order in range(50)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    html = "<p>" + "A sentence of some length here. " * 40 + "</p>"
    spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string").write.parquet(
        f"{tmp_path}/pages.parquet"
    )
    made = []
    chunk_pages = jobs.chunk_pages

    def spied(pages, *rest, **named):
        made.append(pages.count())
        return chunk_pages(pages, *rest, **named)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(jobs, "chunk_pages", spied)
        rows = entry.queries()["chunk_outcomes"](spark, str(tmp_path)).collect()
    assert made == [1]
    assert len(rows) == 50 and {r.status for r in rows} == {"ok"} and {r.n_chunks > 1 for r in rows} == {True}
