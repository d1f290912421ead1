
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundglean import schemas
from fundglean.functions import paths, responses, text
from fundglean.functions.chunking import chunk_text, text_pieces
from fundglean.functions.html import html_to_text, remove_hidden_div
from fundglean.functions.vectors import cosine_distance, hash_embedding
from fundglean.operators import abbreviations, batches, calls, filters, journal, key_filter
from fundglean.operators import pivots, relevance, report, sampling
from fundglean.operators import search, tickers
from fundglean.operators.candidates import candidate_texts, reduce_cascade
from fundglean.operators.chunks import numbered, several_chunks
from fundglean.operators.lineage import cut_lineage, shared_folder
from fundglean.operators.spreading import spread
from fundglean.plans import jobs
from fundglean.plans.bindings import SEARCH_TAG, Given, letter_counts
from fundglean.sources import filings as filing_files
from fundglean.sources import loads, tables
from fundglean.sources.filings import filing_headers, keyed_headers_pages, manifest
from fundglean.sources.fund_lists import columnar_rows
from oracles import ORACLES

KEYS = ["cik", "accession_number"]
DEPTH = 20
CHUNK_SIZE = 500
PAGE_CHUNK_SIZE = 300
DIMENSION = 64
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
    """Register a function of the given tables under its own name.

    A trailing underscore only keeps the name apart from an imported one.
    """
    _QUERIES[build.__name__.rstrip("_")] = lambda spark, folder: build(Given(spark, folder))
    return build


def joined(numbers: Column) -> Column:
    return F.array_join(numbers.cast("array<string>"), ",")


def exported(given: Given, limit: int | None = None) -> DataFrame:
    rows = report.export_rows(given.index(), given.results(), "O", "O", limit)
    return rows.withColumn("chunks_used", joined(F.col("chunks_used")))


# --- index -----------------------------------------------------------------


@query
def index_quarter_counts(given: Given) -> DataFrame:
    date = F.col("date_filed")
    return (
        given.index()
        .groupBy(F.year(date).alias("year"), F.quarter(date).alias("quarter"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def form_type_filter(given: Given) -> DataFrame:
    return filters.of_form_type(given.index(), "1-urgent").select(*KEYS, "form_type")


@query
def tag_filter(given: Given) -> DataFrame:
    return filters.with_tag(given.index(), "F").select(*KEYS, joined(F.col("tags")).alias("tags"))


@query
def date_range_filter(given: Given) -> DataFrame:
    return filters.filed_between(given.index(), "1996-01-01", "1996-12-31").select(
        *KEYS, F.date_format("date_filed", "yyyy-MM-dd").alias("date_filed")
    )


@query
def assign_tags(given: Given) -> DataFrame:
    return filters.assign_tag(given.index(), "10pct").select(
        *KEYS, joined(F.col("tags")).alias("tags")
    )


@query
def delete_exact_tag(given: Given) -> DataFrame:
    return filters.without_exact_tag(given.index(), "F").select(
        *KEYS, joined(F.col("tags")).alias("tags")
    )


@query
def distinct_filings(given: Given) -> DataFrame:
    return filters.filings_of_tag(given.index(), "O")


@query
def batch_limit(given: Given) -> DataFrame:
    return filters.filings_of_tag(given.index(), "O", 100)


@query
def distinct_rows(given: Given) -> DataFrame:
    """Repeated loads of the same index leave every row once."""
    index = given.index()
    return (
        index.unionAll(index)
        .distinct()
        .select(*KEYS, "form_type", "idx_filename", joined(F.col("tags")).alias("tags"))
    )


@query
def sample_semi_join(given: Given) -> DataFrame:
    return given.index().join(given.funds(), "cik", "left_semi").select(*KEYS)


@query
def sample_ten_percent(given: Given) -> DataFrame:
    return sampling.sample_ciks(
        given.index(), given.funds(), "1996-01-01", "1998-12-31", seed="7"
    )


@query
def sample_index(given: Given) -> DataFrame:
    index = given.index()
    drawn = sampling.sample_ciks(index, given.funds(), "1996-01-01", "1998-12-31", seed="7")
    rows = sampling.sample_index(index, drawn, "1997-01-01", "1998-12-31", "10pct")
    return rows.select(
        *KEYS,
        F.date_format("date_filed", "yyyy-MM-dd").alias("date_filed"),
        joined(F.col("tags")).alias("tags"),
    )


@query
def skip_processed_anti_join(given: Given) -> DataFrame:
    filings = given.index().select(*KEYS)
    return filters.not_yet_in(filings, given.results())


@query
def skip_by_key_filter(given: Given) -> DataFrame:
    """The same by way of a filter of the results' filings."""
    filings, done = given.index().select(*KEYS), given.results().select(*KEYS)
    words = key_filter.merged(key_filter.filter_words(done))
    return key_filter.not_done(filings, done, words)


@query
def sketched_stats(given: Given) -> DataFrame:
    """Counts of a vector table after each of three loads, by sketches kept for each load.

    Estimates of distinct values are shown by whether they are within 2 % of exact counts.
    """
    table = f"{shared_folder(given.spark)}/vectors-{uuid.uuid4().hex}"
    states = None
    for version, part in enumerate(("low", "middle", "high"), start=1):
        rows = by_number(given.vectors(), part)
        tables.append_rows(rows, schemas.CHUNK_VECTORS, table, load_id=part)
        about = cut_lineage(jobs.estimated_stats(given.spark, schemas.CHUNK_VECTORS, table))
        loaded = tables.read_table(given.spark, schemas.CHUNK_VECTORS, table)
        exact = report.table_stats(loaded).select(
            F.col("cik").alias("ciks"), F.col("filings").alias("all_filings")
        )
        near = [
            (F.abs(F.col(name) - F.col(count)) <= 0.02 * F.col(count)).alias(f"{name}_near")
            for name, count in (("cik", "ciks"), ("filings", "all_filings"))
        ]
        both = about.join(F.broadcast(exact))  # one row each
        state = both.select(F.lit(version).alias("version"), "total", *near)
        states = state if states is None else states.unionAll(state)
    return states


@query
def single_document_of_type(given: Given) -> DataFrame:
    return filters.document_of_type(given.manifest(), "A", ["filing"])


@query
def filing_manifest(given: Given) -> DataFrame:
    """Index-headers pages, one for each line, read back as manifests."""
    document = F.concat(
        F.lit("&lt;DOCUMENT&gt;\n&lt;TYPE&gt;"),
        "l_returnflag",
        F.lit("\n&lt;SEQUENCE&gt;"),
        F.col("l_linenumber").cast("string"),
        F.lit("\n&lt;FILENAME&gt;"),
        F.col("l_partkey").cast("string"),
        F.lit(".htm\n&lt;DESCRIPTION&gt;A &amp; B\n&lt;TEXT&gt;\n&lt;/TEXT&gt;\n&lt;/DOCUMENT&gt;\n"),
    )
    lines = spread(given.table("lineitem"), "l_orderkey", "l_linenumber", waves=2)
    pages = lines.select(
        F.format_string(
            "edgar/data/%d/%d/%d-index-headers.html", "l_suppkey", "l_orderkey", "l_orderkey"
        ).alias("path"),
        F.concat(
            F.lit("<html><body><PRE>&lt;SEC-HEADER&gt;\nFILED AS OF DATE:\t\t"),
            F.date_format("l_shipdate", "yyyyMMdd"),
            F.lit("\n&lt;/SEC-HEADER&gt;\n"),
            document,
            F.lit("</PRE></body></html>"),
        ).alias("content"),
    )
    return manifest(filing_headers(keyed_headers_pages(pages))).select(
        *KEYS,
        F.date_format("date_filed", "yyyy-MM-dd").alias("date_filed"),
        "type",
        "sequence",
        "filename",
        "path",
    )


# --- paths -----------------------------------------------------------------


@query
def accession_from_path(given: Given) -> DataFrame:
    path = F.col("idx_filename")
    return given.index().select(
        "idx_filename", paths.accession_from_path(path).alias("accession_number")
    )


@query
def parse_path(given: Given) -> DataFrame:
    """Paths of orders parse; page addresses do not."""
    names = given.index().select(F.col("idx_filename").alias("name"))
    names = names.unionAll(given.table("pages").select(F.col("url").alias("name")))
    parsed = names.select("name", paths.parse_path(F.col("name")).alias("p"))
    return parsed.select("name", "p.cik", "p.accession_number", "p.status")


@query
def index_page_path(given: Given) -> DataFrame:
    dashed = F.concat(
        F.lit("edgar/data/"), "cik", F.lit("/000-24-"), "accession_number", F.lit(".txt")
    )
    return given.index().select(
        *KEYS,
        paths.index_page_path(dashed).alias("index_page"),
        paths.headers_page_path(dashed).alias("headers_page"),
    )


# --- report ----------------------------------------------------------------


@query
def export_left_join(given: Given) -> DataFrame:
    return exported(given)


@query
def export_limited(given: Given) -> DataFrame:
    """The first thousand export rows."""
    return exported(given, 1000)


@query
def table_stats(given: Given) -> DataFrame:
    text_rows = report.table_stats(given.chunks()).select(
        F.lit("filing_text_chunks").alias("name"), "*"
    )
    vector_rows = report.table_stats(given.vectors()).select(
        F.lit("filing_chunks_embeddings").alias("name"), "*"
    )
    return text_rows.unionAll(vector_rows)


@query
def outcome_by_filing(given: Given) -> DataFrame:
    return report.outcome_by_filing(given.results(), "F")


@query
def outcome_by_company(given: Given) -> DataFrame:
    return report.outcome_by_company(given.results(), "F")


@query
def ticker_lookup(given: Given) -> DataFrame:
    part, customer = given.table("part"), given.table("customer")
    mapping = part.select(
        F.col("p_type").alias("symbol"),
        F.col("p_partkey").cast("string").alias("cik"),
        F.col("p_partkey").alias("ordinal"),
    )
    asked = (
        part.select(F.concat(F.lower("p_type"), F.lit(" ")).alias("ticker"))
        .unionAll(customer.select(F.col("c_mktsegment").alias("ticker")))
        .unionAll(customer.select(F.substring("c_mktsegment", 1, 3).alias("ticker")))
    )
    return tickers.lookup_tickers(mapping, asked)


@query
def columnar_json_rows(given: Given) -> DataFrame:
    """Every part as a column-oriented JSON text of two rows, read back."""
    files = given.table("part").select(
        F.concat(
            F.lit('{"fields":["cik","seriesId","symbol"],"data":[['),
            F.col("p_partkey").cast("string"),
            F.lit(',"S1","'),
            "p_brand",
            F.lit('"],['),
            F.col("p_size").cast("string"),
            F.lit(',"S2","'),
            "p_type",
            F.lit('"]]}'),
        ).alias("value")
    )
    return columnar_rows(files, ["symbol", "cik"])


# --- text ------------------------------------------------------------------


def documents(given: Given) -> DataFrame:
    return spread(given.table("documents").select("doc_id", "text"), "doc_id")


@query
def chunk_number(given: Given) -> DataFrame:
    return numbered(
        given.table("documents"), F.split("text", "\n"), "chunk_text", ["doc_id"]
    )


@query
def empty_line_flags(given: Given) -> DataFrame:
    lines = F.split("text", "\n")
    return documents(given).select(
        "doc_id",
        F.size(lines).alias("n_lines"),
        F.size(F.filter(lines, text.is_empty_line)).alias("n_empty"),
    )


@query
def table_row_flags(given: Given) -> DataFrame:
    return documents(given).select(
        "doc_id",
        F.size(F.filter(F.split("text", "\n"), text.is_table_row)).alias("n_table_rows"),
    )


@query
def sentences(given: Given) -> DataFrame:
    lines = documents(given).select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_num", "line")
    )
    return lines.select(
        "doc_id", "line_num", F.posexplode(text.sentences(F.col("line"))).alias("n", "sentence")
    )


@query
def abbreviation_scores(given: Given) -> DataFrame:
    """Words of all documents that belong together with their period."""
    found = abbreviations.scores(documents(given), "text")
    return found.withColumn("score", F.round("score", 6))


@query
def learned_sentences(given: Given) -> DataFrame:
    """Sentences that do not end after abbreviations learned from the same documents."""
    known = abbreviations.learned(documents(given), "text")
    lines = documents(given).select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_num", "line")
    )
    cut = text.sentences(F.col("line"), known)
    return lines.select("doc_id", "line_num", F.posexplode(cut).alias("n", "sentence"))


@query
def text_pieces_(given: Given) -> DataFrame:
    return numbered(documents(given), text_pieces(F.col("text")), "piece", ["doc_id"])


@query
def greedy_chunks(given: Given) -> DataFrame:
    return numbered(
        documents(given), chunk_text(F.col("text"), CHUNK_SIZE), "chunk_text", ["doc_id"]
    )


@query
def html_to_text_(given: Given) -> DataFrame:
    pages = spread(given.table("pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", html_to_text(F.col("html")).alias("text"))


@query
def page_structure(given: Given) -> DataFrame:
    """Each page with one of four pieces in front of its article: lists, quotes, rows, links."""
    pieces = [
        "<ol><li>one</li><li>two<ul><li>deep</li><li><p>para</p></li></ul></li><li>three</li></ol>",
        '<blockquote><p>quoted</p><p>again <a href="/u">link</a></p></blockquote>',
        "<table><tr><th>h1</th><th>h2</th></tr><tr><td>a</td><td>b</td></tr></table>",
        '<div><a href="/q"><p>across</p><p>blocks</p></a></div>',
    ]
    piece = F.get(F.lit(pieces), F.pmod("page_id", F.lit(len(pieces))).cast("int"))
    page = F.replace("html", F.lit("<article>"), F.concat(F.lit("<article>"), piece))
    pages = spread(given.table("pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", html_to_text(page).alias("text"))


@query
def hidden_div(given: Given) -> DataFrame:
    """Each page with one of four shapes of hidden div in front of its article.

    Two shapes leave something: a second hidden div, and a div that only looks hidden.
    """
    inside = "><div>a</div><div>b<div>c</div></div></DIV>"
    shapes = [
        f'<DIV id="h" style="color:red; display: none"{inside}',
        f"<div class=x style=display:none{inside}",
        f"<div style='display:none'{inside}<div style='display:none'>second</div>",
        f'<div data-style="display:none">kept</div><div style="display:none"{inside}',
    ]
    shape = F.get(F.lit(shapes), F.pmod("page_id", F.lit(len(shapes))).cast("int"))
    page = F.replace("html", F.lit("<article>"), F.concat(shape, F.lit("<article>")))
    pages = spread(given.table("pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", remove_hidden_div(page).alias("html"))


@query
def chunk_pages(given: Given) -> DataFrame:
    """Page -> text -> chunks; pages of a single chunk are left out."""
    pages = spread(given.table("pages").select("page_id", "html"), "page_id")
    return jobs.chunk_pages(pages, PAGE_CHUNK_SIZE, "html", ["page_id"])


@query
def chunk_outcomes(given: Given) -> DataFrame:
    """What came of each order as a filing whose document, a page, has type A.

    A page is chunked once, however many filings it is the document of.
    """
    pages = given.table("pages").select(
        F.col("page_id").cast("string").alias("path"),
        F.col("html").alias("content"),
        F.length("html").alias("n_chars"),
    )
    kind = F.when(F.col("filename").cast("long") % 5 == 0, ".txt").otherwise(".htm")
    documents_ = filters.document_of_type(given.manifest(), "A", ["filing"]).select(
        "filing", "status", F.concat("filename", kind).alias("filename"),
        F.coalesce("filename", F.lit("")).alias("path"),
    )
    html = documents_.where(F.endswith("filename", F.lit(".htm")))
    wanted = html.select("path").distinct()
    contents = filing_files.with_contents(wanted, pages, "inner")
    chunks = jobs.chunk_pages(contents, PAGE_CHUNK_SIZE, keys=["path"])
    return jobs.outcomes(documents_, pages, chunks, ["filing"], ["path"])


@query
def pages_by_key(given: Given) -> DataFrame:
    """Pages that are documents of orders, from a table laid out by filing.

    Every page is written to a page table, as the document of a filing of its number.
    """
    number = F.col("page_id").cast("string")
    path = F.concat(F.lit("edgar/data/"), number, F.lit("/1"), number, F.lit("/page.htm"))
    pages = given.table("pages").select(path.alias("path"), F.col("html").alias("content"))
    table = f"{shared_folder(given.spark)}/pages-{uuid.uuid4().hex}"
    tables.append_rows(filing_files.laid_out(pages), schemas.PAGES, table)
    named = filters.document_of_type(given.manifest(), "A", ["filing"]).where("status = 'ok'")
    wanted = named.select(
        F.col("filename").alias("cik"), F.concat(F.lit("1"), "filename").alias("accession_number")
    ).distinct()
    written = tables.read_table(given.spark, schemas.PAGES, table, layout=True)
    found = filing_files.pages_of_filings(written, wanted, filing_files.DOCUMENT)
    key = filing_files.filing_key(F.col("cik"), F.col("accession_number"))
    return found.join(wanted.select(key.alias("filing")), "filing", "left_semi").select(
        F.col("cik").cast("long").alias("page_id"), "n_chars", F.md5("content").alias("content")
    )


def by_number(rows: DataFrame, part: str) -> DataFrame:
    """One of three parts of a chunk table, told by chunk number."""
    first, end = {"low": (0, 3), "middle": (3, 6), "high": (6, 10)}[part]
    return rows.where((F.col("chunk_num") >= first) & (F.col("chunk_num") < end))


@query
def committed_loads(given: Given) -> DataFrame:
    """Rows by chunk number in each state of a vector table of three loads, one loaded twice.

    Another load fails after some of its rows are written.
    """
    vectors = given.vectors()
    table = f"{shared_folder(given.spark)}/vectors-{uuid.uuid4().hex}"

    def load(rows: DataFrame, name: str) -> None:
        tables.append_rows(rows, schemas.CHUNK_VECTORS, table, load_id=name)

    load(by_number(vectors, "low"), "low")
    load(by_number(vectors, "middle"), "middle")
    load(by_number(vectors, "low"), "low")
    high = by_number(vectors, "high")
    some = F.when(F.xxhash64("cik", "chunk_num") % 3 != 0, F.col("embedding"))
    try:
        load(high.withColumn("embedding", some), "high")
    except PySparkException:  # a vector is NULL; what has been written is not published
        load(high, "high")
    states = None
    for version in loads.snapshots(given.spark, table):
        rows = tables.read_table(given.spark, schemas.CHUNK_VECTORS, table, version=version)
        counts = rows.groupBy("chunk_num").agg(F.count(F.lit(1)).alias("n"))
        state = counts.select(F.lit(version).alias("version"), "chunk_num", "n")
        states = state if states is None else states.unionAll(state)
    return states


@query
def html_paths(given: Given) -> DataFrame:
    """Addresses of pages, and names made of them, that are HTML files."""
    url = F.col("url")
    names = F.array(url, F.concat(url, F.lit(".htm")), F.concat(url, F.lit(".HTML")),
                    F.concat(url, F.lit(".txt")), F.concat(url, F.lit(".html.gz")))
    rows = given.table("pages").select("page_id", F.posexplode(names).alias("n", "name"))
    return rows.where(paths.is_html_path(F.col("name")))


# --- chunk tables, search and relevance --------------------------------------


@query
def get_chunks_all(given: Given) -> DataFrame:
    """Every third filing asks for all its chunks, by an empty list."""
    filing = F.floor(F.col("vec_id") / 10)
    none = F.array().cast("array<int>")
    requests = (
        given.table("embeddings")
        .groupBy(filing.alias("filing"))
        .agg(F.when(F.col("filing") % 3 == 0, none).otherwise(F.array(F.max("label"))).alias("chunk_nums"))
        .select(F.col("filing").cast("string").alias("cik"),
                F.col("filing").cast("string").alias("accession_number"), "chunk_nums")
    )
    return filters.requested_chunks(given.chunks(), requests)


@query
def ordered_lookup(given: Given) -> DataFrame:
    """All chunks of every filing, numbered in order."""
    in_order = Window.partitionBy(*KEYS).orderBy("chunk_num")
    place = (F.row_number().over(in_order) - 1).alias("place")
    return given.chunks().select(*KEYS, place, "chunk_num", "chunk_text")


@query
def tags_null_and_two(given: Given) -> DataFrame:
    """Filings by tag where some have no tags and some have two."""
    status = F.col("tags")[0]
    tags = (
        F.when(status == "F", F.lit(None).cast("array<string>"))
        .when(F.col("cik").cast("long") % 2 == 0, F.array(status, F.lit("both")))
        .otherwise(F.array(status))
    )
    index = given.index().withColumn("tags", tags)
    kept = filters.without_exact_tag(index, "P")
    marked = kept.withColumn("two_tags", F.coalesce(F.array_contains("tags", "both"), F.lit(False)))
    found = filters.with_tag(marked, "O").select(*KEYS, F.lit("O").alias("found"))
    return marked.select(*KEYS, "two_tags").join(found, KEYS, "left")


@query
def vector_topk_many_phrases(given: Given) -> DataFrame:
    """Every vector as a phrase too, which stream by parts of the chunks."""
    embeddings = given.table("embeddings")
    phrases = embeddings.select(
        F.lpad(F.col("vec_id").cast("string"), 9, "0").alias("phrase"),
        F.col("embedding").alias("phrase_embedding"),
        F.array(F.lit(SEARCH_TAG)).alias("tags"),
    )
    rows = search.top_pairs(given.vectors(), phrases, SEARCH_TAG, DEPTH, shipped_bytes=0)
    return rows.withColumn("distance", F.round("distance", 6))


@query
def phrase_vectors(given: Given) -> DataFrame:
    """The phrase set of a tag: one phrase and vector for each label."""
    rows = filters.with_tag(given.phrases(), SEARCH_TAG)
    entries = rows.select("phrase", F.posexplode("phrase_embedding").alias("i", "x"))
    return entries.withColumn("x", F.round(F.col("x").cast("double"), 6))


@query
def embedded_user_function(given: Given) -> DataFrame:
    """A user's batch function over all chunks, in requests of neighbouring chunks."""
    limits = calls.RequestLimits(1500, 4)
    rows = calls.embedded_chunks(given.chunks(), "chunk_text", letter_counts, limits)
    return rows.select(*KEYS, "chunk_num", joined(F.transform("embedding", lambda x: x.cast("long"))).alias("embedding"))



@query
def get_chunks(given: Given) -> DataFrame:
    """Each filing asks for the chunk numbers found among its vectors' labels."""
    embeddings = given.table("embeddings")
    filing = F.floor(F.col("vec_id") / 10).cast("string")
    requests = embeddings.groupBy(
        filing.alias("cik"), filing.alias("accession_number")
    ).agg(F.collect_set("label").alias("chunk_nums"))
    return filters.requested_chunks(given.chunks(), requests)


@query
def multi_chunk_filings(given: Given) -> DataFrame:
    """Orders as filings, lines as chunks."""
    lines = given.table("lineitem").select(
        F.col("l_orderkey").cast("string").alias("cik"),
        F.col("l_orderkey").cast("string").alias("accession_number"),
        F.col("l_linenumber").alias("chunk_num"),
    )
    return several_chunks(lines)


@query
def cosine_distance_(given: Given) -> DataFrame:
    """Every vector against the phrase of its own label."""
    labelled = given.table("embeddings").withColumn("phrase", F.col("label").cast("string"))
    met = labelled.join(given.phrases(), "phrase")
    distance = cosine_distance(F.col("embedding"), F.col("phrase_embedding"))
    return met.select("vec_id", "phrase", F.round(distance, 6).alias("distance"))


def pairs(given: Given) -> DataFrame:
    return search.top_pairs(given.vectors(), given.phrases(), SEARCH_TAG, DEPTH)


def scores(given: Given) -> DataFrame:
    return relevance.chunk_scores(pairs(given))


@query
def vector_topk(given: Given) -> DataFrame:
    return pairs(given).withColumn("distance", F.round("distance", 6))


@query
def pivot_topk(given: Given) -> DataFrame:
    """The nearest pairs of each filing, found with pivots."""
    rows = pivots.top_pairs(given.vectors(), given.phrases(), SEARCH_TAG, DEPTH)
    return rows.withColumn("distance", F.round("distance", 6))


@query
def relevance_by_distance(given: Given) -> DataFrame:
    return scores(given).select(
        *KEYS,
        "chunk_num",
        F.round("distance_score", 6).alias("score"),
        F.round("avg_distance", 6).alias("avg_distance"),
        F.round("min_distance", 6).alias("min_distance"),
        F.col("distance_rank").alias("rank"),
    )


@query
def relevance_by_appearance(given: Given) -> DataFrame:
    return scores(given).select(
        *KEYS,
        "chunk_num",
        "frequency",
        F.round("avg_distance", 6).alias("avg_distance"),
        F.round("appearance_score", 6).alias("score"),
        F.col("appearance_rank").alias("rank"),
    )


def picked(given: Given, method: str) -> DataFrame:
    chosen = relevance.selected_chunks(scores(given), method)
    return chosen.withColumn("selected_chunks", joined(F.col("selected_chunks")))


@query
def top3_chunks(given: Given) -> DataFrame:
    return picked(given, "distance-any3")


@query
def top3_chunks_by_appearance(given: Given) -> DataFrame:
    return picked(given, "appearance-any3")


@query
def top_adjacent_chunks(given: Given) -> DataFrame:
    return picked(given, "distance")


@query
def top_adjacent_chunks_by_appearance(given: Given) -> DataFrame:
    return picked(given, "appearance")


@query
def cascade_candidates(given: Given) -> DataFrame:
    choices = relevance.selections(scores(given)).select(*KEYS, F.inline("choices"))
    return choices.withColumn("chunks", joined(F.col("chunks")))


def candidates(given: Given) -> DataFrame:
    return candidate_texts(relevance.selections(scores(given)), given.chunks())


@query
def selected_text(given: Given) -> DataFrame:
    rows = candidates(given).select(*KEYS, F.inline("candidates"))
    return rows.withColumn("chunks", joined(F.col("chunks")))


def stand_in_response(snippet: Column) -> Column:
    """As many trustees as the text length leaves over when divided by four."""
    n = F.pmod(F.length(snippet), F.lit(4))
    people = F.transform(
        F.filter(F.sequence(F.lit(0), n), lambda i: i > 0),
        lambda i: F.concat(F.lit('{"name":"T'), i.cast("string"), F.lit('"}')),
    )
    return F.concat(
        F.lit('```json{"trustees":['), F.array_join(people, ","), F.lit("]}```")
    )


def result_rows(answered: DataFrame) -> DataFrame:
    rows = reduce_cascade(answered).drop("error")
    return rows.withColumn("selected_chunks", joined(F.col("selected_chunks")))


@query
def cascade_result(given: Given) -> DataFrame:
    return result_rows(calls.answer_all(candidates(given), stand_in_response))


def stand_in_model(prompts: list[str]) -> list[str]:
    """As :func:`stand_in_response`, as a model that is sent prompts."""
    people = [",".join(f'{{"name":"T{i}"}}' for i in range(1, len(p) % 4 + 1)) for p in prompts]
    return [f'```json{{"trustees":[{some}]}}```' for some in people]


def no_model(prompts: list[str]) -> list[str]:
    """Stands where nothing may be sent."""
    raise RuntimeError(f"{len(prompts)} prompts sent again")


@query
def recorded_answers(given: Given) -> DataFrame:
    """The cascade once with a model, and again from the answers kept of it alone."""
    kept = f"{shared_folder(given.spark)}/answers-{uuid.uuid4().hex}"
    tries = cut_lineage(candidates(given))
    template = "{SEC_FILING_SNIPPET}"
    journal.ask_in_turn(tries, stand_in_model, kept, "model", "first", template, calls_per_task=64)
    again = journal.ask_in_turn(tries, no_model, kept, "model", "second", template)
    return reduce_cascade(again).withColumn("selected_chunks", joined(F.col("selected_chunks")))


@query
def dummy_extract(given: Given) -> DataFrame:
    """Prompts go through the model call; the stand-in model always finds nothing."""
    return result_rows(calls.ask_in_turn(candidates(given), calls.skip_model))


# --- responses and vectors ---------------------------------------------------


@query
def unwrap_json(given: Given) -> DataFrame:
    return given.responses().select(
        "accession_number", responses.unwrap_json(F.col("response")).alias("response")
    )


@query
def trustee_count(given: Given) -> DataFrame:
    unwrapped = responses.unwrap_json(F.col("response"))
    return given.responses().select(
        "accession_number", responses.trustee_count(unwrapped).alias("n_trustee")
    )


@query
def trustee_rows(given: Given) -> DataFrame:
    view = responses.response_view(responses.unwrap_json(F.col("response")))
    rows = given.responses().select("accession_number", view.alias("v"))
    people = rows.select(
        "accession_number",
        F.col("v.notes").alias("notes"),
        F.explode_outer("v.trustees").alias("t"),
    )
    return people.select("accession_number", "notes", F.col("t.name").alias("name"))


@query
def prompts(given: Given) -> DataFrame:
    filled = responses.fill_prompt(F.col("text"), "Read: {SEC_FILING_SNIPPET}\nAnswer.")
    return given.table("documents").select("doc_id", filled.alias("prompt"))


@query
def hash_embedding_(given: Given) -> DataFrame:
    vector = hash_embedding(F.col("text"), DIMENSION)
    entries = documents(given).select("doc_id", F.posexplode(vector).alias("bucket", "x"))
    return entries.where(F.col("x") != 0).select(
        "doc_id", "bucket", F.round(F.col("x").cast("double"), 5).alias("x")
    )


@query
def token_batches_token_limited(given: Given) -> DataFrame:
    """The limits of models that limit tokens alone, on long token counts."""
    tokens = F.size(F.split("chunk_text", " ")) * 20
    return batches.token_batches(given.chunks(), tokens, *calls.TOKEN_LIMITED)


@query
def token_batches_count_limited(given: Given) -> DataFrame:
    tokens = F.size(F.split("chunk_text", " ")) * 20
    return batches.token_batches(given.chunks(), tokens, *calls.COUNT_LIMITED)


@query
def token_batches(given: Given) -> DataFrame:
    tokens = F.size(F.split("chunk_text", " "))
    return batches.token_batches(given.chunks(), tokens, max_tokens=1500, max_chunks=4)


# --- contract ----------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Which adjacent chunks of each filing best match the search phrases?"""
    return top_adjacent_chunks(Given(spark, "/root/testdata/sf0.001"))


def training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL twins of the training-data operators, none if they are not there.

    Only their absence is passed over; an error inside them is raised.
    """
    try:
        import corpus_pipeline
        from fundglean.llm.queries import ORACLES as twins
        from fundglean.llm.queries import QUERIES as added
    except ModuleNotFoundError as error:
        gone = (error.name or "").startswith(("corpus_pipeline", "fundglean.llm"))
        if not gone:
            raise
        return {}, {}
    twins = dict(twins)
    if corpus_pipeline.ORACLE_SQL is not None:
        twins["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**added, "pipeline": corpus_pipeline.run}, twins


def queries() -> dict[str, Query]:
    return {**_QUERIES, **training_data()[0]}


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **training_data()[1]}
