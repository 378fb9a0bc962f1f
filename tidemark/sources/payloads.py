"""Landed API payloads to rows, parsed on the executors.

A payload is one JSON document in a text column. Its size is bounded by one API
response; the number of payloads is not, so every step here is narrow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import typing

TABULAR_TYPE = "array<array<string>>"
#: Column of the texts of payloads that are turned away.
REJECTED = "_rejected"

# Field names of the nested payload, and its words for "latest".
POINT_FIELDS = ("year", "period", "periodName", "value", "latest", "footnotes")
POINT_TYPE = (
    "struct<year:string,period:string,periodName:string,value:string,"
    "latest:string,footnotes:array<map<string,string>>>"
)
PAYLOAD_TYPE = f"Results struct<series:array<struct<seriesID:string,data:array<{POINT_TYPE}>>>>"
LATEST_WORDS = ("true", "True")


def read_payloads(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Payload documents as a ``payload`` text column.

    One document per file is how a fetcher lands them. One per line packs many
    documents into splittable files and is the better layout for large volumes.
    """
    return spark.read.text(path, wholetext=not one_per_line).withColumnRenamed("value", "payload")


def _table(payload: Column) -> Column:
    return F.from_json(payload, TABULAR_TYPE)


def tabular_rejects(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Payloads that are not a non-empty list of lists."""
    return payloads.where(F.coalesce(F.size(_table(F.col(column))), F.lit(0)) < 1)


def _last_position(header: Column, name: str) -> Column:
    """Zero-based place of the last header cell called ``name``; -1 when absent."""
    from_end = F.array_position(F.reverse(header), name)
    return F.when(from_end > 0, F.size(header) - from_end).otherwise(-1).cast("int")


def tabular_records(
    payloads: DataFrame, columns: Sequence[str], column: str = "payload"
) -> DataFrame:
    """Tabular payloads to one row per record; payloads of another form give none.

    The first inner list names the columns of the rest. The longer of header and
    record is cut, and of repeated header names the last one that is left counts.
    ``columns`` is the wanted projection; a name no header has comes back NULL.
    Header places are found once per payload, below the explode, and again only for
    short records. The document comes out of a generator, through which no filter is
    pushed, so it is parsed once whatever is asked of its records.
    """
    found = records_or_rejects(payloads, columns, column)
    return found.where(F.col(REJECTED).isNull()).drop(REJECTED)


def records_or_rejects(
    payloads: DataFrame, columns: Sequence[str], column: str = "payload"
) -> DataFrame:
    """The rows of ``tabular_records``, and one row for each payload that it turns away.

    ``REJECTED`` holds the text of such a payload and is NULL in records, so one parse
    serves both.
    """
    text = F.col(column)
    tables = payloads.select(text, F.explode(F.array(_table(text))).alias("t"))
    broken = F.coalesce(F.size("t"), F.lit(0)) < 1
    header = F.get(F.col("t"), F.lit(0))
    places = F.array(*[_last_position(F.col("header"), c) for c in columns])
    # A broken payload has one row without cells; a table without records has none.
    rows = F.when(broken, F.array(F.array().cast("array<string>"))).otherwise(
        F.slice("t", 2, F.size("t"))
    )
    # A NULL document is rejected too, as an empty text.
    rejected = F.when(broken, F.coalesce(text, F.lit("")))
    parts = tables.select(header.alias("header"), rows.alias("body"), rejected.alias(REJECTED))
    placed = parts.select("header", places.alias("at"), "body", REJECTED)
    rows = placed.select("header", "at", F.explode("body").alias("row"), REJECTED)
    short = F.size("row") < F.size("header")
    cut = F.slice("header", 1, F.size("row"))

    def cell(i: int, name: str) -> Column:
        at = F.when(short, _last_position(cut, name)).otherwise(F.get(F.col("at"), F.lit(i)))
        held = F.col(REJECTED).isNull()
        return F.when(held, F.get(F.col("row"), at)).alias(name)

    return rows.select(*[cell(i, c) for i, c in enumerate(columns)], REJECTED)


def _series(payloads: DataFrame, column: str) -> DataFrame:
    parsed = F.from_json(F.col(column), PAYLOAD_TYPE)
    return payloads.select(F.inline(parsed["Results"]["series"]))


def all_points(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Every data point of every series; missing levels give no rows."""
    return _series(payloads, column).select("seriesID", F.inline("data"))


def latest_points(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Per series of a payload the first flagged point, else the first point.

    A series without points, or whose chosen point is an empty object, gives
    no row.
    """
    data = F.col("data")
    flagged = F.filter(data, lambda p: p["latest"].isin(*LATEST_WORDS))
    pick = F.coalesce(F.get(flagged, F.lit(0)), F.get(data, F.lit(0)))

    def has_field(point: Column) -> Column:
        return F.coalesce(*[point[f].cast("string") for f in POINT_FIELDS]).isNotNull()

    chosen = F.filter(F.array(pick), has_field)
    return _series(payloads, column).select("seriesID", F.inline(chosen))


def choose_points(
    payloads: DataFrame,
    latest_only: bool,
    column: str = "payload",
    series: Sequence[str] | None = None,
    first_year: int | None = None,
    last_year: int | None = None,
) -> DataFrame:
    """Points of the wanted series and years; a point without a year is in no range of years."""
    points = latest_points(payloads, column) if latest_only else all_points(payloads, column)
    if series is not None:
        points = points.where(F.col("seriesID").isin(*series))
    year = typing.integer(F.col("year"))
    if first_year is not None:
        points = points.where(year >= first_year)
    if last_year is not None:
        points = points.where(year <= last_year)
    return points
