"""Quarterly pipe-separated filing indexes."""

from __future__ import annotations

import re
import warnings
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundglean.functions.paths import accession_from_path
from fundglean.operators.filters import of_form_type

INDEX_COLUMNS = "cik string, company_name string, form_type string, date_filed string, idx_filename string"


def existing_quarters(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """Year and quarter of the index files that are there, in order."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{root}/edgar/full-index/*/QTR*/master.idx")
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    found = [str(status.getPath()) for status in system.globStatus(path) or []]
    named = (re.search(r"/(\d{4})/QTR([1-4])/master\.idx$", name) for name in found)
    return sorted((int(m[1]), int(m[2])) for m in named if m)


def wanted_quarters(
    existing: list[tuple[int, int]], pattern: str
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Quarters whose ``YYYY/Q`` matches a shell pattern: those there, and gaps among them.

    A gap matches the pattern, lies between the first and the last quarter of the
    archive, and has no file. A pattern that nothing matches is an error.
    """
    chosen = [q for q in existing if fnmatch(f"{q[0]}/{q[1]}", pattern)]
    if not chosen:
        raise ValueError(f"no quarter of the archive matches {pattern!r}")
    years = range(existing[0][0], existing[-1][0] + 1)
    between = [(y, q) for y in years for q in range(1, 5) if existing[0] < (y, q) < existing[-1]]
    gaps = [
        q for q in between if q not in existing and fnmatch(f"{q[0]}/{q[1]}", pattern)
    ]
    return chosen, gaps


def quarter_glob(spark: SparkSession, root: str, pattern: str) -> str:
    """One path glob for the quarters that match; gaps are reported by a warning."""
    chosen, gaps = wanted_quarters(existing_quarters(spark, root), pattern)
    if gaps:
        missing = ", ".join(f"{y}/{q}" for y, q in gaps)
        warnings.warn(f"quarters without an index file: {missing}", stacklevel=3)
    names = ",".join(f"{y}/QTR{q}" for y, q in chosen)
    return f"{root}/edgar/full-index/{{{names}}}/master.idx"


def read_master_index(
    spark: SparkSession, root: str, pattern: str, form_type: str = "", encoding: str = "UTF-8"
) -> DataFrame:
    """Index rows of the chosen quarters, with ``year`` and ``quarter``.

    Header lines are told apart by not having an archive path, so the files stay
    splittable. Quotes are ordinary characters. Bytes that do not decode become
    U+FFFD.
    """
    path = F.col("_metadata.file_path")
    rows = (
        spark.read.schema(INDEX_COLUMNS)
        .option("sep", "|")
        .option("quote", "")
        .option("encoding", encoding)
        .csv(quarter_glob(spark, root, pattern))
        .withColumn("year", F.regexp_extract(path, r"/(\d{4})/QTR\d/", 1).cast("int"))
        .withColumn("quarter", F.regexp_extract(path, r"/QTR(\d)/", 1).cast("int"))
        .where(F.col("idx_filename").like("edgar/data/%"))
    )
    return of_form_type(rows, form_type).select(
        "cik",
        "company_name",
        "form_type",
        F.col("date_filed").cast("date").alias("date_filed"),
        "idx_filename",
        accession_from_path(F.col("idx_filename")).alias("accession_number"),
        F.lit(None).cast("array<string>").alias("tags"),
        "year",
        "quarter",
    )


def quarter_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("year", "quarter").agg(F.count(F.lit(1)).alias("n"))
