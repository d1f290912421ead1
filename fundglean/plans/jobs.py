"""The jobs of the pipeline, as functions of DataFrames and table paths."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundglean import schemas
from fundglean.functions.binding import let
from fundglean.functions.chunking import DEFAULT_CHUNK_SIZE, chunk_text
from fundglean.functions.html import html_to_text
from fundglean.functions.paths import is_html_path
from fundglean.functions.responses import PROMPT, response_view
from fundglean.functions.vectors import hash_embedding
from fundglean.operators import calls, filters, journal, key_filter, relevance, report, sampling
from fundglean.operators import search, sketches, tickers
from fundglean.operators.candidates import candidate_texts, reduce_cascade
from fundglean.operators.chunks import numbered, of_filings
from fundglean.operators.lineage import cut_lineage
from fundglean.sources import filings as filing_files
from fundglean.sources import derived, fund_lists, index_files, tables
from fundglean.schemas import FILING_KEYS

FORM_TYPE = "485BPOS"
FULL_INDEX = replace(schemas.MASTER_INDEX, partitions=schemas.QUARTER)
DIMENSION = 768
SEARCH_DEPTH = 20
BROADCAST_PATHS = 500_000  # rows of keys and a path, some 100 bytes each

# The built-in search phrases.
SEARCH_PHRASES = (
    "Trustee Compensation Structure and Amount",
    "Independent Director or Trustee Compensation Table",
    "Board Director or Intereed Person Compensation Details with Amount",
    "Interested Person Compensation Remuneration Detailed Amount",
)


@dataclass(frozen=True)
class Tables:
    """Paths of the pipeline's tables; the names below are fixed values."""

    full_index: str
    index: str
    pages: str
    outcomes: str
    text: str
    embedding: str
    search: str
    result: str
    journal: str

    @classmethod
    def under(cls, root: str) -> Tables:
        return cls(
            full_index=f"{root}/master_idx",
            index=f"{root}/master_idx_sample",
            pages=f"{root}/filing_pages",
            outcomes=f"{root}/filing_outcomes",
            text=f"{root}/filing_text_chunks",
            embedding=f"{root}/filing_chunks_embeddings",
            search=f"{root}/search_phrase_embeddings",
            result=f"{root}/trustee_comp_results",
            journal=f"{root}/model_answers",
        )


def _table(spark: SparkSession, spec: schemas.TableSpec, path: str) -> DataFrame:
    table = tables.read_table(spark, spec, path)
    if table is None:
        raise ValueError(f"no table at {path}")
    return table


def load_index(
    spark: SparkSession,
    archive: str,
    quarters: str,
    to: Tables,
    form_type: str = FORM_TYPE,
    load_id: str | None = None,
) -> dict[tuple[int, int], int]:
    """Append the index rows of the chosen quarters; rows of each quarter that was read.

    A load with the id of an earlier one is not repeated.
    """
    existing = index_files.existing_quarters(spark, archive)
    read, _ = index_files.wanted_quarters(existing, quarters)
    rows = index_files.read_master_index(spark, archive, quarters, form_type)
    groups = {
        f"{y}/{q}": (F.col("year") == y) & (F.col("quarter") == q) for y, q in read
    }
    counts = tables.append_counted(rows, FULL_INDEX, to.full_index, groups, load_id)
    return {(y, q): counts[f"{y}/{q}"] for y, q in read}


def index_counts(
    spark: SparkSession, archive: str, quarters: str, form_type: str = FORM_TYPE
) -> DataFrame:
    """Rows that loading would append, by year and quarter."""
    return index_files.quarter_counts(
        index_files.read_master_index(spark, archive, quarters, form_type)
    )


def _index_between(spark: SparkSession, at: Tables, *ranges: tuple[str, str]) -> DataFrame:
    """Index rows of the years of the date ranges; other quarters' files are not read."""
    index = tables.read_table(spark, FULL_INDEX, at.full_index, layout=True)
    if index is None:
        raise ValueError(f"no table at {at.full_index}")
    first, last = min(r[0] for r in ranges), max(r[1] for r in ranges)
    years = F.col("year").between(int(first[:4]), int(last[:4]))
    return index.where(years).select(*schemas.MASTER_INDEX.schema.fieldNames())


def sample(
    spark: SparkSession,
    at: Tables,
    funds: DataFrame,
    tag: str = "10pct",
    draw_range: tuple[str, str] = ("2002-01-01", "2004-12-31"),
    keep_range: tuple[str, str] = ("2003-01-01", "2004-12-31"),
    seed: str = "",
) -> bool:
    """Tag the filings of a tenth of the fund companies, in place of an earlier sample."""
    index = _index_between(spark, at, draw_range, keep_range)
    drawn = sampling.sample_ciks(index, funds, *draw_range, seed=seed)
    rows = sampling.sample_index(index, drawn, *keep_range, tag=tag)
    return tables.replace_rows(rows, schemas.MASTER_INDEX, at.index)


def chunk_pages(
    pages: DataFrame,
    size: int = DEFAULT_CHUNK_SIZE,
    page_column: str = "content",
    keys=FILING_KEYS,
    abbreviations: Sequence[str] | None = None,
) -> DataFrame:
    """HTML pages with filing keys -> numbered chunks; no shuffle.

    Filings that give a single chunk are dropped inside the expression: a filter
    after it would be pushed down and work out the chunks a second time.
    """
    chunks = let(
        chunk_text(html_to_text(F.col(page_column)), size, abbreviations),
        lambda found: F.when(F.size(found) > 1, found),
    )
    return numbered(pages, chunks, "chunk_text", keys)


def ingest_pages(spark: SparkSession, archive: str, to: Tables, ciks: str = "*") -> bool:
    """Copy pages of the archive that are not there yet into the page table.

    Files are listed by path and held against the table's paths; only new ones are read. The
    table is laid out by kind of page and filing, so that later jobs read the pages
    of their filings and never list the archive. ``ciks`` is a path pattern.
    """
    listed = filing_files.list_pages(spark, f"{archive}/edgar/data/{ciks}/*/*.htm*")
    there = tables.read_table(spark, schemas.PAGES, to.pages)
    done = False
    for found in filing_files.unread_pages(listed, there):
        done |= tables.append_rows(filing_files.laid_out(found), schemas.PAGES, to.pages)
    return done


def pages_of(spark: SparkSession, at: Tables, filings: DataFrame, kind: str) -> DataFrame:
    """Pages of a kind of the given filings."""
    pages = tables.read_table(spark, schemas.PAGES, at.pages, layout=True)
    if pages is None:
        raise ValueError(f"no table at {at.pages}")
    return filing_files.pages_of_filings(pages, filings, kind)


def outcomes(
    documents: DataFrame,
    pages: DataFrame,
    chunks: DataFrame,
    keys=FILING_KEYS,
    chunk_keys: Sequence[str] | None = None,
) -> DataFrame:
    """What came of each filing: keys, ``status`` and ``n_chunks``.

    ``documents`` has the keys, ``filename``, ``path`` and a status: ``ok``,
    ``missing`` or ``ambiguous``. An ok document may turn out ``not_html``,
    ``no_content`` (no page at its path) or ``single`` (one chunk or none). Of ``pages``
    (``path``, ``n_chars``) no content is read. ``chunks`` has the columns ``chunk_keys`` of
    ``documents``, the filing's keys if none are given.
    """
    chunk_keys = list(keys if chunk_keys is None else chunk_keys)
    there = pages.where(F.col("n_chars").isNotNull()).select("path", F.lit(True).alias("there"))
    counts = chunks.groupBy(*chunk_keys).agg(F.count(F.lit(1)).alias("n"))
    status = (
        F.when(F.col("status") != "ok", F.col("status"))
        .when(~is_html_path(F.col("filename")), "not_html")
        .when(F.col("there").isNull(), "no_content")
        .when(F.col("n").isNull(), "single")
        .otherwise("ok")
    )
    return (
        documents.join(there.distinct(), "path", "left")
        .join(counts, chunk_keys, "left")
        .select(*keys, status.alias("status"), F.coalesce("n", F.lit(0)).alias("n_chunks"))
    )


def chunk(
    spark: SparkSession,
    at: Tables,
    tag: str,
    form_type: str = FORM_TYPE,
    batch_limit: int = 0,
    size: int = DEFAULT_CHUNK_SIZE,
    retry: Sequence[str] = (),
    abbreviations: Sequence[str] | None = None,
) -> bool:
    """Chunk the tagged filings that are not settled yet, and note what came of each.

    With ``abbreviations``, as ``operators.abbreviations`` learns them, sentences do not end
    after one.

    A filing is settled once it has an outcome, whatever it is, unless that is one
    of ``retry``; its last outcome counts.
    """
    with filing_files.pushing_keys(spark):
        return _chunk(spark, at, tag, form_type, batch_limit, size, retry, abbreviations)


def _chunk(
    spark: SparkSession,
    at: Tables,
    tag: str,
    form_type: str,
    batch_limit: int,
    size: int,
    retry: Sequence[str],
    abbreviations: Sequence[str] | None,
) -> bool:
    keys = list(FILING_KEYS)
    index = _table(spark, schemas.MASTER_INDEX, at.index)
    settled = tables.read_table(spark, schemas.OUTCOMES, at.outcomes)
    if settled is not None and retry:
        again = settled.groupBy(*keys).agg(F.bool_and(F.col("status").isin(*retry)).alias("again"))
        settled = again.where(~F.col("again"))
    todo = cut_lineage(
        filters.not_yet_in(filters.filings_of_tag(index, tag, batch_limit), settled)
    )
    if todo.isEmpty():
        return False
    headers = filing_files.keyed_headers_pages(pages_of(spark, at, todo, filing_files.HEADERS))
    wanted = headers.join(todo, keys, "left_semi")  # before a page is parsed
    manifest = filing_files.manifest(filing_files.filing_headers(wanted))
    found = filters.document_of_type(manifest.withColumn("filename", F.col("path")), form_type)
    documents = cut_lineage(
        todo.join(found, keys, "left").select(
            *keys,
            "filename",
            F.coalesce(F.col("filename"), F.lit("")).alias("path"),
            F.coalesce("status", F.lit("missing")).alias("status"),
        )
    )
    # Chunks of an earlier run that ended before it noted outcomes are not made again.
    readable = filters.not_yet_in(
        documents.where((F.col("status") == "ok") & is_html_path(F.col("filename"))),
        tables.read_table(spark, schemas.TEXT_CHUNKS, at.text),
    ).select(*keys, "path")
    if documents.count() <= BROADCAST_PATHS:
        readable = F.broadcast(readable)  # page contents then stay where they were read
    pages = pages_of(spark, at, todo, filing_files.DOCUMENT).select("path", "n_chars", "content")
    contents = filing_files.with_contents(readable, pages, "inner")
    made = chunk_pages(contents, size, abbreviations=abbreviations)
    done = tables.append_rows(made, schemas.TEXT_CHUNKS, at.text)
    written = tables.read_table(spark, schemas.TEXT_CHUNKS, at.text)
    chunks = of_filings(written.select(*keys), todo)
    tables.append_rows(outcomes(documents, pages, chunks), schemas.OUTCOMES, at.outcomes)
    return done


def embedding(
    spark: SparkSession,
    at: Tables,
    tag: str,
    embed: calls.Embed | None = None,
    dimension: int = DIMENSION,
    batch_limit: int = 0,
    limits: calls.RequestLimits = calls.COUNT_LIMITED,
    count_tokens: Callable[[Column], Column] = calls.word_count,
) -> bool:
    """Vectors for the chunks of tagged filings that have none yet.

    Without a function of the user, hashed word counts serve as vectors. With one,
    each request holds neighbouring chunks of one filing within ``limits``. Filings
    of a single chunk never reach the text table, so there is none to leave out.
    """
    keys = list(FILING_KEYS)
    index = _table(spark, schemas.MASTER_INDEX, at.index)
    tagged = filters.filings_of_tag(index, tag, batch_limit)
    todo = unfinished(spark, tagged, schemas.CHUNK_VECTORS, at.embedding)
    chunks = of_filings(_table(spark, schemas.TEXT_CHUNKS, at.text), todo)
    if embed is None:
        vector = hash_embedding(F.col("chunk_text"), dimension).alias("embedding")
        vectors = chunks.select(*keys, "chunk_num", vector)
    else:
        vectors = calls.embedded_chunks(chunks, "chunk_text", embed, limits, count_tokens)
    return tables.append_rows(vectors, schemas.CHUNK_VECTORS, at.embedding, dimension)


def init_search_phrases(
    spark: SparkSession,
    at: Tables,
    search_tag: str,
    embed: calls.Embed | None = None,
    dimension: int = DIMENSION,
    phrases: tuple[str, ...] = SEARCH_PHRASES,
) -> None:
    """Replace the phrases of a tag."""
    rows = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    if embed is None:
        rows = rows.withColumn("phrase_embedding", hash_embedding(F.col("phrase"), dimension))
    else:
        answer = F.get(calls.embedded(F.array("phrase"), embed), 0)
        rows = rows.withColumn("phrase_embedding", answer)
    tables.replace_phrases(filters.assign_tag(rows, search_tag), at.search, dimension)


def candidates_of(
    vectors: DataFrame,
    chunks: DataFrame,
    phrases: DataFrame,
    search_tag: str,
    depth: int = SEARCH_DEPTH,
) -> DataFrame:
    """Search once for all filings, rank, select, fetch texts."""
    pairs = search.top_pairs(vectors, phrases, search_tag, depth)
    choices = relevance.selections(relevance.chunk_scores(pairs))
    return candidate_texts(choices, chunks)


def extract(
    spark: SparkSession,
    at: Tables,
    tag: str,
    search_tag: str,
    result_tag: str,
    model: str,
    ask: calls.Ask = calls.skip_model,
    batch_limit: int = 0,
    template: str = PROMPT,
    calls_per_task: int = 1,
) -> bool:
    """Ask about the most relevant chunks of every tagged filing and store the result.

    Answers are kept in the journal as they come; a run after a failure, or one with the
    same prompts, sends only what has no answer yet. Skipped calls are not kept.
    """
    index = _table(spark, schemas.MASTER_INDEX, at.index)
    todo = filters.filings_of_tag(index, tag, batch_limit)
    vectors = of_filings(_table(spark, schemas.CHUNK_VECTORS, at.embedding), todo)
    candidates = candidates_of(
        vectors,
        _table(spark, schemas.TEXT_CHUNKS, at.text),
        _table(spark, schemas.SEARCH_PHRASES, at.search),
        search_tag,
    )
    if ask is calls.skip_model:
        answered = calls.ask_in_turn(candidates, ask, template)
    else:
        answered = journal.ask_in_turn(
            candidates, ask, at.journal, model, result_tag, template, calls_per_task=calls_per_task
        )
    results = reduce_cascade(answered).select(
        "*",
        F.lit(model).alias("model"),
        response_view(F.col("response")).alias("comp_info"),
    )
    return tables.append_rows(
        filters.assign_tag(results, result_tag), schemas.RESULTS, at.result
    )


def export(
    spark: SparkSession,
    at: Tables,
    tag: str,
    result_tag: str,
    output: str,
    limit: int | None = None,
) -> None:
    """Tagged filings with their results as JSON lines; all of them unless limited."""
    rows = report.export_rows(
        _table(spark, schemas.MASTER_INDEX, at.index),
        _table(spark, schemas.RESULTS, at.result),
        tag,
        result_tag,
        limit,
    )
    tables.write_json_lines(rows, output)


def statistics(spark: SparkSession, at: Tables, tag: str = "orig225") -> dict[str, DataFrame]:
    """One single-row DataFrame for each summary."""
    results = _table(spark, schemas.RESULTS, at.result)
    return {
        "master_idx_sample": _table(spark, schemas.MASTER_INDEX, at.index).agg(
            F.count(F.lit(1)).alias("count")
        ),
        "filing_text_chunks": report.table_stats(_table(spark, schemas.TEXT_CHUNKS, at.text)),
        "filing_chunks_embeddings": report.table_stats(
            _table(spark, schemas.CHUNK_VECTORS, at.embedding)
        ),
        "results_by_filing": report.outcome_by_filing(results, tag),
        "results_by_company": report.outcome_by_company(results, tag),
    }


def estimated_stats(spark: SparkSession, spec: schemas.TableSpec, path: str) -> DataFrame | None:
    """About what ``report.table_stats`` counts of a table; a new load reads only its own rows."""
    kept = derived.by_load(
        spark, spec, path, schemas.SKETCHES, f"{path}_sketches",
        lambda rows: sketches.sketched(rows, derived.FOLDER),
    )
    return None if kept is None else sketches.merged(kept)


def unfinished(
    spark: SparkSession, filings: DataFrame, spec: schemas.TableSpec, path: str
) -> DataFrame:
    """Filings without a row in a table, by way of a filter of its filings kept for each load."""
    done = tables.read_table(spark, spec, path)
    kept = derived.by_load(
        spark, spec, path, schemas.KEY_FILTERS, f"{path}_filters",
        lambda rows: key_filter.filter_words(rows, derived.FOLDER),
    )
    if done is None or kept is None:
        return filters.not_yet_in(filings, done)
    return key_filter.not_done(filings, done, key_filter.merged(kept))


def map_tickers(spark: SparkSession, mapping_json: str, fund_list: str, output: str) -> None:
    """Ticker -> cik map as a two-column CSV."""
    mapping = fund_lists.read_columnar_json(spark, mapping_json, ["symbol", "cik"])
    asked = fund_lists.read_fund_list(spark, fund_list)
    fund_lists.write_ticker_map(tickers.lookup_tickers(mapping, asked), output)
