"""Typed Parquet tables: checked loads, replacement by tag, JSON-lines export."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fundglean.schemas import SEARCH_PHRASES, TableSpec
from fundglean.sources import loads

TAG_KEY = "tag_key"


def _checked(column: Column, bad: Column, message: str) -> Column:
    return F.when(bad, F.raise_error(F.lit(message))).otherwise(column)


def conform(
    df: DataFrame, spec: TableSpec, dimension: int | None = None, layout: tuple[str, ...] = ()
) -> DataFrame:
    """Columns of the table in order and type; a row that breaks a rule fails the write.

    Columns the rows do not have are NULL. The rules are column expressions and
    run in the write's own stage.
    """
    columns = []
    for field in spec.schema:
        name = field.name
        given = F.col(name) if name in df.columns else F.lit(None)
        column = given.cast(field.dataType)
        if name in spec.max_length:
            longest = spec.max_length[name]
            column = _checked(
                column, F.length(column) > longest, f"{name} is longer than {longest}"
            )
        if name == spec.vector and dimension is not None:
            column = _checked(
                column, F.size(column) != dimension, f"{name} must have {dimension} numbers"
            )
        if name in spec.required:
            column = _checked(column, column.isNull(), f"{name} must not be NULL")
        columns.append(column.alias(name))
    return df.select(*columns, *layout)


def append_rows(
    df: DataFrame,
    spec: TableSpec,
    path: str,
    dimension: int | None = None,
    load_id: str | None = None,
) -> bool:
    """Append a load to the table, creating it if need be; False if there was no row.

    A load whose id was published before is not repeated.
    """
    return _load(df, spec, path, dimension, load_id)[ROWS] > 0


def append_counted(
    df: DataFrame,
    spec: TableSpec,
    path: str,
    groups: dict[str, Column],
    load_id: str | None = None,
) -> dict[str, int]:
    """As :func:`append_rows`; the rows of each group are counted by the write itself.

    A repeated load counts nothing.
    """
    counts = _load(df, spec, path, None, load_id, groups=groups)
    return {name: counts.get(name, 0) for name in groups}


ROWS = "rows"


def _load(
    df: DataFrame,
    spec: TableSpec,
    path: str,
    dimension: int | None,
    load_id: str | None = None,
    replace: bool = False,
    groups: dict[str, Column] | None = None,
) -> dict[str, int]:
    """Rows are counted while they are written, not in a pass of their own."""
    seen: dict[str, int] = {}

    def write(folder: str) -> int:
        counted = Observation()
        counts = [F.count_if(column).alias(name) for name, column in (groups or {}).items()]
        rows = conform(df, spec, dimension, spec.partitions)
        rows = rows.observe(counted, F.count(F.lit(1)).alias(ROWS), *counts)
        rows.write.options(**spec.write_options).partitionBy(*spec.partitions).parquet(folder)
        seen.update(counted.get)
        return seen[ROWS]

    rows = loads.load(df.sparkSession, path, write, load_id, replace)
    return {**seen, ROWS: rows}


def replace_rows(
    df: DataFrame, spec: TableSpec, path: str, dimension: int | None = None
) -> bool:
    """As :func:`append_rows`, in place of what the table held.

    ``df`` may come from the table itself: what it held stays readable by its snapshot.
    """
    return _load(df, spec, path, dimension, replace=True)[ROWS] > 0


def read_table(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    layout: bool = False,
    version: int | None = None,
    only: set[str] | None = None,
) -> DataFrame | None:
    """The table as last published, or None while it does not exist.

    With ``layout`` also what it is laid out by and the folder of the load; ``version`` is
    the number of an earlier snapshot, ``only`` the ids of some loads. A folder of files
    without snapshots is read as it is.
    """
    found = loads.snapshot(spark, path, version)
    reader = spark.read.schema(spec.schema)
    try:
        if found is None:
            rows = reader.parquet(path)
        else:
            folders = [
                f"{path}/{x.folder}" for x in found.loads if x.folder and (only is None or x.id in only)
            ]
            if not folders:
                return spark.createDataFrame([], spec.schema)
            rows = reader.option("basePath", path).parquet(*folders)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    names = [c for c in rows.columns if layout or c in spec.schema.fieldNames()]
    return rows.select(*names)


def replace_phrases(df: DataFrame, path: str, dimension: int | None = None) -> None:
    """Write phrases in place of those whose tag array is exactly the same.

    The table is partitioned by its tag array and only the partitions written to
    are replaced, so the table is never read and overwritten in one job.
    """
    rows = conform(df, SEARCH_PHRASES, dimension).withColumn(TAG_KEY, F.to_json("tags"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(TAG_KEY)
        .parquet(path)
    )


def write_json_lines(df: DataFrame, path: str) -> None:
    """JSON lines that keep NULL fields."""
    df.write.option("ignoreNullFields", "false").json(path)
