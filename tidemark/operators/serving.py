"""Serving views over gold tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import contracts as C
from tidemark.functions import calendar
from tidemark.operators.latest import as_of_latest


def fact_latest(fact: DataFrame) -> DataFrame:
    """Newest period of every fact series."""
    newest = as_of_latest(fact, C.FACT_SERIES_KEYS, ("dt",), ("ingest_date", "cell_value"))
    return newest.select(*C.FACT_GOLD_COLUMNS).withColumnRenamed("cell_value", "value")


def series_monthly(fact: DataFrame) -> DataFrame:
    return fact.select(
        "dt",
        "year",
        "month",
        "category_code",
        "data_type_code",
        "time_slot_id",
        "is_seasonally_adjusted",
        F.col("cell_value").alias("value"),
    )


def series_latest(latest: DataFrame) -> DataFrame:
    return latest.select(*C.SERVING_COLUMNS)


def dim_date(fact: DataFrame, day: str = "dt", today: dt.date | None = None) -> DataFrame:
    """One row per calendar day from the first to the last day of ``fact``.

    An empty fact has no first day and so gives no rows. The bounds are one
    aggregate over one column; the calendar itself is a few thousand rows.
    """
    end = F.lit(today) if today is not None else F.current_date()
    bounds = fact.agg(F.min(day).alias("lo"), F.coalesce(F.max(day), end).alias("hi"))
    step = F.expr("interval 1 day")
    days = bounds.select(
        F.explode(F.sequence(F.col("lo").cast("date"), F.col("hi").cast("date"), step)).alias("dt")
    )
    return days.select(
        "dt",
        F.year("dt").alias("year"),
        F.month("dt").alias("month"),
        calendar.month_abbr(F.col("dt")).alias("month_abbr"),
        calendar.year_month_text(F.col("dt")).alias("year_month"),
    )


def row_counts(**tables: DataFrame) -> DataFrame:
    """Row count per named table."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    total = counts[0]
    for c in counts[1:]:
        total = total.unionByName(c)
    return total
