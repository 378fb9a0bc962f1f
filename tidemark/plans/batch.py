"""Batch path: payloads to bronze, silver, gold and serving."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contracts as C
from tidemark.functions import calendar, typing
from tidemark.operators import gate, keyed, layout, serving
from tidemark.operators.latest import latest_per_key
from tidemark.sources import payloads as P
from tidemark.sources.tables import read_jsonl, read_partitioned
from tidemark.workspace import delete, ensure_folder, folders, hidden, publish

FACT_PARTITIONS = ("year", "month")


def land_payloads(
    spark: SparkSession,
    payloads: DataFrame,
    raw: str,
    bronze: str,
    ingest_date: dt.date,
    since: str | None = None,
    columns: Sequence[str] = C.FACT_RAW_COLUMNS,
    replace_day: bool = False,
) -> DataFrame:
    """Payloads to JSON Lines, then to the bronze day; returns the payloads turned away.

    ``raw`` is a folder of its own for this run; ``raw`` + ``.rejects`` gets the payloads
    of another form. Both come out of one write, so payloads are read and parsed once,
    and bronze is built from what was written.
    """
    found = P.records_or_rejects(payloads, columns)
    held = F.col(P.REJECTED).isNull()
    if since is not None:
        found = found.where(~held | (F.col("time") >= F.lit(since)))
    made, kind = hidden(raw.rsplit("/", 1)[0]), F.when(held, "records").otherwise("rejects")
    layout.write_jsonl(found.withColumn(keyed.KIND, kind), made, [keyed.KIND])
    for name, final in (("records", raw), ("rejects", f"{raw}.rejects")):
        delete(spark, final)
        if not publish(spark, ensure_folder(spark, f"{made}/{keyed.KIND}={name}"), final):
            raise ValueError(f"{final} is being written by another run")
    delete(spark, made)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    layout.append_ingest(read_jsonl(spark, raw, schema), bronze, ingest_date, replace_day)
    rejects = T.StructType([T.StructField(P.REJECTED, T.StringType())])
    return read_jsonl(spark, f"{raw}.rejects", rejects).withColumnRenamed(P.REJECTED, "payload")


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    """Typed, ordered projection of raw fact rows; narrow."""
    C.require_columns(bronze, C.FACT_RAW_COLUMNS)
    tail = ["ingest_date"] if "ingest_date" in bronze.columns else []
    return (
        bronze.withColumns(
            {
                "time_slot_id": typing.integer(F.col("time_slot_id")),
                "cell_value": typing.amount(F.col("cell_value")),
                "is_seasonally_adjusted": typing.flag_or_null(F.col("seasonally_adj")),
                "date": calendar.year_month_to_date(F.col("time")),
            }
        )
        .withColumns({"year": F.year("date"), "month": F.month("date")})
        .select(*C.FACT_SILVER_COLUMNS, *tail)
    )


def _days(day: dt.date | None) -> str | None:
    return day.isoformat() if day else None


def _read_days(
    spark: SparkSession, root: str, since: dt.date | None, until: dt.date | None
) -> DataFrame:
    column = "ingest_date" if since or until else None
    return read_partitioned(spark, root, column, _days(since), _days(until))


def build_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    since: dt.date | None = None,
    until: dt.date | None = None,
) -> None:
    """Type the bronze table into silver.

    Without bounds the whole table is rebuilt. With them only the ingest days between
    are listed, read and replaced, which is the daily run on a large table.
    """
    typed = bronze_to_silver(_read_days(spark, bronze, since, until))
    layout.write_partitioned(
        typed, silver, layout.partition_columns(typed), replace_all=not (since or until)
    )


def silver_to_gold(silver: DataFrame) -> DataFrame:
    """Renamed and reordered for the fact table, ingest date as a date."""
    return (
        silver.withColumnRenamed("date", "dt")
        .withColumn("ingest_date", F.to_date("ingest_date"))
        .select(*C.FACT_GOLD_COLUMNS)
    )


def fact_delta(gold_rows: DataFrame) -> DataFrame:
    """Rows that meet the contract, newest per key."""
    valid = gate.valid_rows(gold_rows, C.FACT)
    return latest_per_key(valid, C.FACT.keys, C.FACT_RECENCY, C.FACT_TIE)


def build_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    since: dt.date | None = None,
    label: str | None = None,
    until: dt.date | None = None,
) -> gate.Measures | None:
    """Append the newest row per key to the fact table; the incoming row wins.

    With bounds only the ingest days between are taken. Silver is read once: the rows
    that break the contract come out of the same ranking and are published with the
    others. A ``label`` names the run: under one that is published already, nothing is
    done. What the run measured is returned.
    """
    keyed.settle_order(spark, gold, ())
    if label is not None and keyed.is_published(spark, gold, label, 0):
        return None
    rows, measure = gate.measured(silver_to_gold(_read_days(spark, silver, since, until)), C.FACT)
    newest = gate.newest_or_rejected(rows, C.FACT, C.FACT.keys, C.FACT_RECENCY, C.FACT_TIE)
    kind = F.when(F.col(gate.REASON).isNull(), keyed.CHANGES).otherwise(keyed.REJECTS)
    made, inside = keyed.prepare(gold, label, 0)
    newest.withColumn(keyed.KIND, kind).write.partitionBy(keyed.KIND).parquet(inside)
    seen = measure()
    if seen.rows:
        stamp = keyed.publish_step(spark, gold, made)
        keyed.fold_if_due(spark, gold, C.FACT.keys, stamp, keyed.FOLD_EVERY, FACT_PARTITIONS)
    else:
        delete(spark, made)
    return seen


def read_gold(spark: SparkSession, gold: str) -> DataFrame | None:
    fact = keyed.read(spark, gold, C.FACT.keys)
    return None if fact is None else fact.select(*C.FACT_GOLD_COLUMNS)


def refresh_fact_latest(spark: SparkSession, gold: str, view: str) -> int:
    """Bring the maintained view of the newest period of each series up to date.

    Only the rows that came to the fact table since the last refresh are read, and only
    the series they touch are written. A row of a later period takes the place of the
    one that is shown; a row that came again for the period that is shown replaces it,
    whatever its value; rows of earlier periods change nothing. If rows since then
    have been taken up by a base already, the view is brought up from the whole table.
    Returns how many series were written.
    """
    done = [keyed.number_of(p, keyed.STEP) for p in folders(spark, f"{view}/steps/*/*/{keyed.STEP}=*")]
    last, stamps = max([0, *done]), keyed.stamps(spark, gold)
    newest = max([0, *stamps])
    if newest <= last:
        return 0
    if set(range(last + 1, newest + 1)) <= set(stamps):
        rows = keyed.read_kind(spark, gold, keyed.CHANGES, after=last)
        order = ("dt", keyed.STAMP)
    else:
        rows, order = read_gold(spark, gold), ("dt",)
    if rows is None:
        return 0
    seen = Observation()
    changed = latest_per_key(rows, C.FACT_SERIES_KEYS, order, order).select(*C.FACT_GOLD_COLUMNS)
    counted = changed.observe(seen, F.count("*").alias("series"))
    keyed.append(spark, view, counted, C.FACT_SERIES_KEYS, ("dt",), "fact_latest", newest)
    return gate.figures(seen).get("series", 0)


def read_fact_latest(spark: SparkSession, view: str) -> DataFrame | None:
    """The maintained view, with the columns of ``serving.fact_latest``."""
    rows = keyed.read(spark, view, C.FACT_SERIES_KEYS)
    if rows is None:
        return None
    return rows.select(*C.FACT_GOLD_COLUMNS).withColumnRenamed("cell_value", "value")


def fold_gold(spark: SparkSession, gold: str) -> None:
    keyed.fold(spark, gold, C.FACT.keys, FACT_PARTITIONS)


def build_serving(
    fact: DataFrame, today: dt.date | None = None, latest: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Serving frames, derived after gold so they never lag; also temp views.

    ``latest`` is the stream's latest table, for ``series_latest``.
    """
    views = {
        "fact_latest": serving.fact_latest(fact),
        "series_monthly": serving.series_monthly(fact),
        "dim_date": serving.dim_date(fact, today=today),
    }
    if latest is not None:
        views["series_latest"] = serving.series_latest(latest)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
