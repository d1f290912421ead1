"""The given star-schema tables seen as the pipeline's tables.

Every frame is made from a whole table; what the given tables lack (responses,
index-headers pages, hidden divs) is derived from them row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundglean.functions.paths import index_path

SEARCH_TAG = "group1"

# Columns of the given tables, so that no footer is read to infer them.
TABLE_COLUMNS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
}
CHUNKS_PER_FILING = 10


def letter_counts(texts: list[str]) -> list[list[float]]:
    """A user's embedding function in the small: sizes, and how often two letters occur."""
    return [[float(len(t)), float(t.count("e")), float(t.count(" "))] for t in texts]


class Given:
    """Lazy frames over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(TABLE_COLUMNS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def index(self) -> DataFrame:
        cik = F.col("o_custkey").cast("string")
        accession = F.col("o_orderkey").cast("string")
        return self.table("orders").select(
            cik.alias("cik"),
            F.concat(F.lit("Customer "), cik).alias("company_name"),
            F.col("o_orderpriority").alias("form_type"),
            F.col("o_orderdate").cast("date").alias("date_filed"),
            index_path(cik, accession).alias("idx_filename"),
            accession.alias("accession_number"),
            F.array("o_orderstatus").alias("tags"),
        )

    def funds(self) -> DataFrame:
        return (
            self.table("customer")
            .where(F.col("c_mktsegment") == "MACHINERY")
            .select(F.col("c_custkey").cast("string").alias("cik"))
        )

    def manifest(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("filing"),
            F.col("l_returnflag").alias("type"),
            F.col("l_linenumber").alias("sequence"),
            F.col("l_partkey").cast("string").alias("filename"),
        )

    def results(self) -> DataFrame:
        """One row per order that has lines; ``n_trustee`` counts returned ones."""
        per_order = (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.count_if(F.col("l_returnflag") == "A").cast("int").alias("n_trustee"),
                F.array_sort(F.collect_set("l_linenumber")).alias("selected_chunks"),
                F.max("l_partkey").cast("string").alias("selected_text"),
                F.min("l_suppkey").cast("string").alias("response"),
            )
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        return per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").cast("string").alias("cik"),
            F.col("o_orderkey").cast("string").alias("accession_number"),
            "selected_chunks",
            "selected_text",
            "response",
            "n_trustee",
            F.array("o_orderstatus").alias("tags"),
        )

    def _filing_of(self, key: str) -> list:
        filing = F.floor(F.col(key) / CHUNKS_PER_FILING).cast("string")
        number = F.pmod(F.col(key), F.lit(CHUNKS_PER_FILING)).cast("int")
        return [
            filing.alias("cik"),
            filing.alias("accession_number"),
            number.alias("chunk_num"),
        ]

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(*self._filing_of("vec_id"), "embedding")

    def chunks(self) -> DataFrame:
        return self.table("documents").select(
            *self._filing_of("doc_id"), F.col("text").alias("chunk_text")
        )

    def phrases(self) -> DataFrame:
        """The first vector of every label stands for a search phrase."""
        return (
            self.table("embeddings")
            .groupBy("label")
            .agg(F.min_by("embedding", "vec_id").alias("phrase_embedding"))
            .select(
                F.col("label").cast("string").alias("phrase"),
                "phrase_embedding",
                F.array(F.lit(SEARCH_TAG)).alias("tags"),
            )
        )

    def responses(self) -> DataFrame:
        """One response per order: bare, fenced, chatty, cut off, or without a list."""
        counted = (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(F.count_if(F.col("l_returnflag") == "A").cast("int").alias("n"))
        )
        orders = self.table("orders").select("o_orderkey", "o_orderpriority")
        joined = orders.join(counted, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        people = F.transform(
            F.filter(F.sequence(F.lit(0), F.coalesce("n", F.lit(0))), lambda i: i > 0),
            lambda i: F.concat(F.lit('{"name":"T'), i.cast("string"), F.lit('"}')),
        )
        body = F.concat(
            F.lit('{"compensation_info_present":true,"trustees":['),
            F.array_join(people, ","),
            F.lit('],"notes":"'),
            F.col("o_orderpriority"),
            F.lit('"}'),
        )
        kind = F.col("o_orderpriority")
        response = (
            F.when(kind == "1-URGENT", body)
            .when(kind == "2-HIGH", F.concat(F.lit("```json\n"), body, F.lit("\n```")))
            .when(
                kind == "3-MEDIUM",
                F.concat(F.lit("As asked: ```json"), body, F.lit("```\nRegards")),
            )
            .when(
                kind == "4-NOT SPECIFIED",
                F.concat(F.lit("```json"), F.substring(body, 1, 40), F.lit("```")),
            )
            .otherwise(F.concat(F.lit('  {"notes": "none '), F.lit("x"), F.lit('"}  ')))
        )
        return joined.select(
            F.col("o_orderkey").cast("string").alias("accession_number"),
            response.alias("response"),
        )
