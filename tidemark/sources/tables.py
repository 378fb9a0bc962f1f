"""Readers of landed and layered files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calendar import ISO_MICROS
from tidemark.workspace import folders

# Six fraction digits both ways: the default writing cuts clock readings to milliseconds.
JSON_OPTIONS = {"timestampNTZFormat": ISO_MICROS}

_NO_FILES = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON Lines with a declared schema, so the files are read once."""
    return spark.read.options(**JSON_OPTIONS).schema(schema).json(path)


def _bound(df: DataFrame, column: str, value) -> Column:
    """A limit in the type of the column itself: no cast of the column keeps the
    predicate from the scan, and no zone comes in between for clock readings."""
    return F.lit(str(value)).cast(df.schema[column].dataType)


def partition_folders(
    spark: SparkSession, root: str, column: str, since: dt.date | None, until: dt.date | None
) -> list[str]:
    """The folders of a day partition between two days; only their names are looked at."""
    found = []
    for path in folders(spark, f"{root}/{column}=*"):
        try:
            day = dt.date.fromisoformat(path.rsplit("=", 1)[1])
        except ValueError:  # rows without a day
            continue
        if (since is None or day >= since) and (until is None or day <= until):
            found.append(path)
    return found


def read_partitioned(
    spark: SparkSession,
    root: str,
    column: str | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """A partitioned table, or the partitions of a range of days of it.

    With a bound, the day folders in the range are named to the scan, so planning
    lists their files only, however many days the table has. Without one in the range,
    the table's schema comes from any other, and there are no rows.
    """
    if column is None or (since is None and until is None):
        return spark.read.parquet(root)
    bounds = [None if x is None else dt.date.fromisoformat(str(x)) for x in (since, until)]
    reader = spark.read.option("basePath", root)
    if chosen := partition_folders(spark, root, column, *bounds):
        return reader.parquet(*chosen)
    return reader.parquet(*partition_folders(spark, root, column, None, None)[:1] or [root]).limit(0)


def schema_or(spark: SparkSession, path: str, fallback: T.StructType) -> T.StructType:
    """Schema in the file footers of ``path``, else ``fallback``; no row is read."""
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as problem:
        if problem.getCondition() not in _NO_FILES:
            raise
        return fallback


def select_window(
    df: DataFrame,
    time_column: str,
    columns: Sequence[str] | None = None,
    since=None,
    until=None,
    series_column: str | None = None,
    series: Sequence | None = None,
) -> DataFrame:
    """Rows a request would have asked for; every predicate can reach the file scan."""
    if since is not None:
        df = df.where(F.col(time_column) >= _bound(df, time_column, since))
    if until is not None:
        df = df.where(F.col(time_column) <= _bound(df, time_column, until))
    if series is not None:
        df = df.where(F.col(series_column).isin(*series))
    return df.select(*columns) if columns else df
