"""Filing pages: the manifest on the index-headers page, and document contents."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundglean.functions.html import decode_entities
from fundglean.functions.text import WHITESPACE
from fundglean.operators.lineage import cut_lineage

# Each goes from one ``<`` to the next and never back, instead of by single characters.
_PRE = r"<(?i:pre)\b[^>]*+>([^<]*+(?:<(?!(?i:/pre\s*>))[^<]*+)*+)"
_HEADER = r"<(?i:SEC-HEADER)>[^<]*+(?:<(?!(?i:/SEC-HEADER|DOCUMENT)>)[^<]*+)*+"
_DOCUMENT = r"<(?i:DOCUMENT)>[^<]*+(?:<(?!(?i:/DOCUMENT)>)[^<]*+)*+</(?i:DOCUMENT)>"
# The rest of a line without white space at its ends.
_STRIPPED = rf"[{WHITESPACE}&&[^\r\n]]*+((?:[^\r\n<]*[^\r\n<{WHITESPACE}])?)"
_ARCHIVE_PATH = r"(edgar/data/.*)$"
HEADERS, DOCUMENT = "headers", "document"
PAGE_BUCKETS = 64
PATHS_PER_READ = 50_000  # files handed to one read, and paths held by the driver at a time
KEYS_PUSHED = 10_000  # filings named to the scan of the page table
IN_FILTER_CONF = "spark.sql.parquet.pushdown.inFilterThreshold"


def list_pages(spark: SparkSession, *paths: str) -> DataFrame:
    """``(path, file)`` of files, whose contents are not read: archive path and whole path."""
    found = spark.read.format("binaryFile").load(list(paths)).select(F.col("path").alias("file"))
    return found.select(F.regexp_extract("file", _ARCHIVE_PATH, 1).alias("path"), "file")


def unread_pages(listed: DataFrame, known: DataFrame | None) -> Iterator[DataFrame]:
    """Contents of the listed pages whose path is not ``known``, so many files at a time."""
    new = listed if known is None else listed.join(known.select("path"), "path", "left_anti")
    files = (row.file for row in cut_lineage(new.select("file")).toLocalIterator())
    while some := list(islice(files, PATHS_PER_READ)):
        yield read_pages(listed.sparkSession, *some)


def read_pages(spark: SparkSession, *paths: str) -> DataFrame:
    """``(path, content)`` of files, one row each; the path starts at ``edgar/data``."""
    return spark.read.text(list(paths), wholetext=True).select(
        F.regexp_extract("_metadata.file_path", _ARCHIVE_PATH, 1).alias("path"),
        F.col("value").alias("content"),
    )


def filing_key(cik: Column, accession_number: Column) -> Column:
    """A filing as the page table names it; an accession number counts without dashes."""
    return F.concat(cik, F.lit("/"), F.replace(accession_number, F.lit("-"), F.lit("")))


def page_bucket(filing: Column) -> Column:
    """Where the page table keeps a filing."""
    return F.pmod(F.xxhash64(filing), F.lit(PAGE_BUCKETS)).cast("int")


def laid_out(pages: DataFrame) -> DataFrame:
    """Pages as the page table keeps them: by kind and bucket, and in a file by filing.

    A bucket is written by few tasks, large ones by several, so files are neither many nor
    huge; in order of filings a file's row groups tell which they hold.
    """
    headers = F.endswith("path", F.lit("-index-headers.html"))
    cik = F.regexp_extract("path", r"edgar/data/([^/]+)/", 1)
    folder = F.regexp_extract("path", r"edgar/data/[^/]+/([^/]+)/", 1)
    named = pages.withColumns(
        {"cik": cik, "filing": filing_key(cik, folder), "n_chars": F.length("content").cast("long")}
    ).withColumns(
        {
            "kind": F.when(headers, HEADERS).otherwise(DOCUMENT),
            "bucket": page_bucket(F.col("filing")),
        }
    )
    dealt = named.hint("rebalance", F.col("kind"), F.col("bucket"))
    return dealt.sortWithinPartitions("kind", "bucket", "filing", "path")


@contextmanager
def pushing_keys(spark: SparkSession) -> Iterator[None]:
    """Scans that run inside look for up to ``KEYS_PUSHED`` named keys in each row group."""
    before = spark.conf.get(IN_FILTER_CONF)
    spark.conf.set(IN_FILTER_CONF, str(KEYS_PUSHED))
    try:
        yield
    finally:
        spark.conf.set(IN_FILTER_CONF, before)


def pages_of_filings(pages: DataFrame, filings: DataFrame, kind: str) -> DataFrame:
    """Pages of a kind of the given filings, from the page table.

    The filings' buckets are told to the scan, and up to ``KEYS_PUSHED`` filings themselves:
    within :func:`pushing_keys` row groups that hold none of them are not read. Beyond
    that the other filings of their buckets come along.
    """
    key = filing_key(F.col("cik"), F.col("accession_number"))
    named = filings.select(key.alias("filing")).distinct()
    keys = [r.filing for r in named.limit(KEYS_PUSHED + 1).collect()]
    buckets = named.select(page_bucket(F.col("filing")).alias("bucket")).distinct().collect()
    found = pages.where((F.col("kind") == kind) & F.col("bucket").isin([r.bucket for r in buckets]))
    return found.where(F.col("filing").isin(keys)) if len(keys) <= KEYS_PUSHED else found


def keyed_headers_pages(pages: DataFrame) -> DataFrame:
    """Add the filing keys, which the path of an index-headers page tells."""
    return pages.withColumns(
        {
            "cik": F.regexp_extract("path", r"edgar/data/(\d+)/", 1),
            "accession_number": F.regexp_extract(
                "path", r"(?s)^(?:.*/)?([^/]+)-index-headers\.html$", 1
            ),
        }
    )


def filing_headers(pages: DataFrame) -> DataFrame:
    """``cik, accession_number, date_filed, folder, documents`` of keyed headers pages.

    A page without a header block has no date and no documents.
    """
    # Columns of their own are worked out once a page, however often they are used.
    about = (
        "cik",
        "accession_number",
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"),
    )
    text = pages.select(*about, F.regexp_extract("content", _PRE, 1).alias("pre"))
    text = text.select(*text.columns[:-1], decode_entities(F.col("pre")).alias("sgml"))
    text = text.withColumn("header", F.regexp_extract("sgml", _HEADER, 0))
    has_header = F.col("header") != ""
    filed = F.regexp_extract("header", r"(?i)FILED AS OF DATE:\s*(\d{8})", 1)

    def field(document, name: str):
        return F.regexp_extract(document, rf"<(?i:{name})>{_STRIPPED}", 1)

    documents = F.transform(
        F.regexp_extract_all("sgml", F.lit(_DOCUMENT), 0),
        lambda d: F.struct(
            field(d, "TYPE").alias("type"),
            field(d, "SEQUENCE").try_cast("int").alias("sequence"),
            field(d, "FILENAME").alias("filename"),
        ),
    )
    return text.select(
        "cik",
        "accession_number",
        F.when(has_header, F.try_to_date(filed, "yyyyMMdd")).alias("date_filed"),
        "folder",
        F.when(has_header, documents).alias("documents"),
    )


def manifest(headers: DataFrame) -> DataFrame:
    """One row per document: keys, date, type, sequence, filename and its path."""
    described = F.filter(
        "documents", lambda d: (d["type"] != "") & (d["filename"] != "")
    )
    documents = headers.select(
        "cik", "accession_number", "date_filed", "folder", F.inline(described)
    )
    return documents.withColumn("path", F.concat_ws("/", "folder", "filename")).drop("folder")


def with_contents(wanted: DataFrame, pages: DataFrame, how: str = "left") -> DataFrame:
    """Add ``content`` by ``path``; with a left join a missing file has NULL content."""
    return wanted.join(pages.select("path", "content"), "path", how)
