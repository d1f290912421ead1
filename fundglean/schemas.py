"""Fixed table schemas. Nothing in this package infers a schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

FILING_KEYS = ("cik", "accession_number")

# The JSON contract of one extraction response.
TRUSTEE = (
    T.StructType()
    .add("year", T.StringType())
    .add("name", T.StringType())
    .add("job_title", T.StringType())
    .add("fund_compensation", T.StringType())
    .add("fund_group_compensation", T.StringType())
    .add("deferred_compensation", T.StringType())
    .add("other_compensation", T.MapType(T.StringType(), T.StringType()))
)
RESPONSE = (
    T.StructType()
    .add("compensation_info_present", T.BooleanType())
    .add("trustees", T.ArrayType(TRUSTEE))
    .add("notes", T.StringType())
)


@dataclass(frozen=True)
class TableSpec:
    """Schema plus the checks a write must pass."""

    schema: T.StructType
    required: tuple[str, ...]
    max_length: dict[str, int] = field(default_factory=dict)
    vector: str | None = None
    #: Columns of the rows that the files are laid out by; without any, by load.
    partitions: tuple[str, ...] = ()
    #: Options of the files, such as filters on keys.
    write_options: dict[str, str] = field(default_factory=dict)


MASTER_INDEX = TableSpec(
    schema=T.StructType()
    .add("cik", T.StringType())
    .add("company_name", T.StringType())
    .add("form_type", T.StringType())
    .add("date_filed", T.DateType())
    .add("idx_filename", T.StringType())
    .add("accession_number", T.StringType())
    .add("tags", T.ArrayType(T.StringType())),
    required=(
        "cik",
        "company_name",
        "form_type",
        "date_filed",
        "idx_filename",
        "accession_number",
    ),
    max_length={
        "cik": 10,
        "company_name": 255,
        "form_type": 16,
        "idx_filename": 255,
        "accession_number": 20,
    },
)

QUARTER = ("year", "quarter")

PAGES = TableSpec(
    schema=T.StructType()
    .add("cik", T.StringType())
    .add("filing", T.StringType())
    .add("path", T.StringType())
    .add("n_chars", T.LongType())
    .add("content", T.StringType()),
    required=("cik", "filing", "path"),
    partitions=("kind", "bucket"),
    # Pages are large, so few make a row group, and a filter on filings can leave many out.
    write_options={
        "parquet.bloom.filter.enabled#filing": "true",
        "parquet.bloom.filter.expected.ndv#filing": "16",
        "parquet.block.row.count.limit": "8",
    },
)

OUTCOMES = TableSpec(
    schema=T.StructType()
    .add("cik", T.StringType())
    .add("accession_number", T.StringType())
    .add("status", T.StringType())
    .add("n_chunks", T.LongType()),
    required=("cik", "accession_number", "status"),
)

TEXT_CHUNKS = TableSpec(
    schema=T.StructType()
    .add("cik", T.StringType())
    .add("accession_number", T.StringType())
    .add("chunk_num", T.IntegerType())
    .add("chunk_text", T.StringType()),
    required=("cik", "accession_number", "chunk_num", "chunk_text"),
    max_length={"cik": 10, "accession_number": 20},
)

CHUNK_VECTORS = TableSpec(
    schema=T.StructType()
    .add("cik", T.StringType())
    .add("accession_number", T.StringType())
    .add("chunk_num", T.IntegerType())
    .add("embedding", T.ArrayType(T.FloatType())),
    required=("cik", "accession_number", "chunk_num", "embedding"),
    max_length={"cik": 10, "accession_number": 20},
    vector="embedding",
)

SEARCH_PHRASES = TableSpec(
    schema=T.StructType()
    .add("phrase", T.StringType())
    .add("phrase_embedding", T.ArrayType(T.FloatType()))
    .add("tags", T.ArrayType(T.StringType())),
    required=(),
    max_length={"phrase": 255},
    vector="phrase_embedding",
)

RESULTS = TableSpec(
    schema=T.StructType()
    .add("cik", T.StringType())
    .add("accession_number", T.StringType())
    .add("model", T.StringType())
    .add("selected_chunks", T.ArrayType(T.IntegerType()))
    .add("selected_text", T.StringType())
    .add("response", T.StringType())
    .add("comp_info", RESPONSE)
    .add("n_trustee", T.IntegerType())
    .add("tags", T.ArrayType(T.StringType()))
    .add("error", T.StringType()),
    required=(
        "cik",
        "accession_number",
        "model",
        "selected_chunks",
        "selected_text",
        "response",
    ),
    # Fixed values, here and above: lengths of the text columns.
    max_length={"cik": 10, "accession_number": 20, "model": 32},
)

#: Answers of a model, a row for each prompt that was sent; laid out by run.
JOURNAL = (
    T.StructType()
    .add("prompt_hash", T.StringType())
    .add("model", T.StringType())
    .add("response", T.StringType())
    .add("error", T.StringType())
    .add("run", T.StringType())
)

#: Distinct-count sketches of each load of a table with filing keys.
SKETCHES = TableSpec(
    schema=T.StructType()
    .add("folder", T.StringType())
    .add("rows", T.LongType())
    .add("ciks", T.BinaryType())
    .add("filings", T.BinaryType()),
    required=("folder", "rows"),
)

#: Words of the filter of each load's filings that have bits set.
KEY_FILTERS = TableSpec(
    schema=T.StructType()
    .add("folder", T.StringType())
    .add("word", T.IntegerType())
    .add("bits", T.LongType()),
    required=("folder", "word", "bits"),
)
