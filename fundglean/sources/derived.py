"""Tables derived from the loads of another, load by load.

What is derived from a load stands in a table of its own with the load's folder; a load
that has been derived is never read again for it, and what became of older loads
matters only as long as the table's snapshot names them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundglean.schemas import TableSpec
from fundglean.sources import loads, tables

FOLDER = "folder"


def by_load(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    derived: TableSpec,
    derived_path: str,
    derive: Callable[[DataFrame], DataFrame],
) -> DataFrame | None:
    """Rows of ``derived`` for the loads of the table as last published, None without a table.

    ``derive`` gives them from the rows of loads, which have their load in ``folder``. Only
    loads without derived rows are read.
    """
    last = loads.snapshot(spark, path)
    if last is None:
        return None
    named = {x.folder: x.id for x in last.loads if x.folder}
    known = tables.read_table(spark, derived, derived_path)
    there = set() if known is None else {r[FOLDER] for r in known.select(FOLDER).distinct().collect()}
    new = {x for folder, x in named.items() if folder not in there}
    if new:
        rows = tables.read_table(spark, spec, path, layout=True, only=new)
        folder = F.concat(F.lit(f"{loads.LOAD}="), F.col(loads.LOAD).cast("string"))
        made = derive(rows.withColumn(FOLDER, folder))
        tables.append_rows(made, derived, derived_path)
        known = tables.read_table(spark, derived, derived_path)
    return None if known is None else known.where(F.col(FOLDER).isin(list(named)))
