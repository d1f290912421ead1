"""Archive paths of filings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_PATTERN = r"edgar/data/(\d+)/(.+)\.txt"  # fixed value: layout of the archive


def accession_from_path(path: Column) -> Column:
    """Last path segment without ``.txt``."""
    without = F.replace(path, F.lit(".txt"), F.lit(""))
    return F.element_at(F.split(without, "/"), -1)


def parse_path(path: Column) -> Column:
    """``struct(cik, accession_number, status)``; status is ``ok`` or ``invalid_path``."""
    cik = F.regexp_extract(path, PATH_PATTERN, 1)
    valid = F.coalesce(cik != "", F.lit(False))
    return F.struct(
        F.when(valid, cik).alias("cik"),
        F.when(valid, F.regexp_extract(path, PATH_PATTERN, 2)).alias("accession_number"),
        F.when(valid, F.lit("ok")).otherwise(F.lit("invalid_path")).alias("status"),
    )


def index_path(cik: Column, accession_number: Column) -> Column:
    """Path under which the quarterly index lists a filing."""
    return F.concat(F.lit("edgar/data/"), cik, F.lit("/"), accession_number, F.lit(".txt"))


def _page_path(path: Column, ending: str) -> Column:
    folder = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    accession = accession_from_path(path)
    plain = F.replace(accession, F.lit("-"), F.lit(""))
    return F.concat_ws("/", folder, plain, F.concat(accession, F.lit(ending)))


def index_page_path(path: Column) -> Column:
    return _page_path(path, "-index.html")


def headers_page_path(path: Column) -> Column:
    return _page_path(path, "-index-headers.html")


def is_html_path(path: Column) -> Column:
    return F.endswith(path, F.lit(".html")) | F.endswith(path, F.lit(".htm"))
