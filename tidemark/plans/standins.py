"""The given tables dressed as the layers of the pipeline.

``orders`` plays the periodic fact and ``events`` the series stream. Every row
of a table takes part. Documents are built from id ranges of unique ids, so no
document can outgrow its range however skewed the users are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contracts as C
from tidemark.functions import calendar
from tidemark.functions.messages import encode_points
from tidemark.plans.batch import bronze_to_silver, silver_to_gold

IDS_PER_DOCUMENT = 500
SHIFTS = (0, 1, 2)

PERIOD_OF_TYPE = {"view": "M01", "click": "M02", "purchase": "M03", "signup": "M13"}
OTHER_PERIOD = "Q01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shift(time: Column | None = None) -> Column:
    """Eight-hour shift of a time: three arrivals that interleave in time."""
    return F.floor(F.hour("ts" if time is None else time) / 8).cast("int")


def _period() -> Column:
    code = F.lit(OTHER_PERIOD)
    for kind, period in PERIOD_OF_TYPE.items():
        code = F.when(F.col("event_type") == kind, period).otherwise(code)
    return code


def _document(unique_id: str) -> Column:
    """Document of a unique id: at most IDS_PER_DOCUMENT rows share one."""
    return F.expr(f"cast({unique_id} as bigint) div {IDS_PER_DOCUMENT}")


def points(events: DataFrame) -> DataFrame:
    """One payload point per event, with the event's id and time kept alongside."""
    return events.select(
        F.col("user_id").cast("string").alias("seriesID"),
        F.year("ts").cast("string").alias("year"),
        _period().alias("period"),
        F.col("event_type").alias("periodName"),
        F.col("value").cast("string").alias("value"),
        F.when(F.col("event_type") == "purchase", "true").otherwise("false").alias("latest"),
        F.array(F.create_map(F.lit("text"), F.col("props"))).alias("footnotes"),
        "event_id",
        "ts",
    )


def nested_payloads(events: DataFrame) -> DataFrame:
    """Nested documents, each with the points of one id range, grouped by series.

    One shuffle: rows placed by document are already together per document and
    series as well.
    """
    notes = F.transform("footnotes", lambda note: F.struct(note["text"].alias("text")))
    point = F.struct("year", "period", "periodName", "value", "latest", notes.alias("footnotes"))
    by_series = (
        points(events)
        .withColumn("document", _document("event_id"))
        .repartition("document")
        .groupBy("document", "seriesID")
        .agg(F.sort_array(F.collect_list(F.struct("event_id", point.alias("p")))).alias("rows"))
        .select("document", F.struct("seriesID", F.col("rows.p").alias("data")).alias("s"))
    )
    results = F.struct(F.struct(F.collect_list("s").alias("series")).alias("Results"))
    return by_series.groupBy("document").agg(F.to_json(results).alias("payload"))


def fact_raw(orders: DataFrame) -> DataFrame:
    """Orders as loosely typed fact rows: unknown flags, odd periods, comma numbers."""
    day = F.col("o_orderdate")
    month = F.substring(F.trunc(day, "quarter").cast("string"), 1, 7)
    odd = F.concat(F.year(day).cast("string"), F.lit("-Q1"))
    return orders.select(
        F.lit("SM").alias("data_type_code"),
        F.dayofweek(day).cast("string").alias("time_slot_id"),
        F.when(F.col("o_orderstatus") == "P", " Yes")
        .when(F.col("o_orderstatus") == "F", "no")
        .otherwise(F.col("o_orderstatus"))
        .alias("seasonally_adj"),
        F.col("o_orderpriority").alias("category_code"),
        F.format_number("o_totalprice", 2).alias("cell_value"),
        F.col("o_orderkey").cast("string").alias("error_data"),
        F.when(F.col("o_orderpriority") == "5-LOW", odd).otherwise(month).alias("time"),
        F.trunc(day, "month").alias("ingest_date"),
    )


def tabular_payloads(orders: DataFrame) -> DataFrame:
    """Header-and-rows documents, each with one range of order keys."""
    cells = F.array(*C.FACT_RAW_COLUMNS)
    header = F.array(*[F.lit(c) for c in C.FACT_RAW_COLUMNS])
    rows = fact_raw(orders).select(
        _document("error_data").alias("document"),
        cells.alias("cells"),
    )
    return (
        rows.groupBy("document")
        .agg(F.collect_list("cells").alias("cells"))
        .select(F.to_json(F.concat(F.array(header), F.col("cells"))).alias("payload"))
    )


def gold_rows(orders: DataFrame) -> DataFrame:
    return silver_to_gold(bronze_to_silver(fact_raw(orders)))


def messages(events: DataFrame) -> DataFrame:
    """Keyed messages with binary parts, each stamped with its event time."""
    encoded = encode_points(points(events), calendar.iso_text(F.col("ts")))
    return encoded.select(F.col("key").cast("binary"), F.col("value").cast("binary"))


def with_corrupt(encoded: DataFrame, is_corrupt: Column) -> DataFrame:
    body = F.when(is_corrupt, F.lit("{broken").cast("binary")).otherwise(F.col("value"))
    return encoded.withColumn("value", body)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream; the braces make the path a pattern, which a
    table held in one single file needs."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events}}.parquet")


def shown(rows: DataFrame, *names: str) -> DataFrame:
    """Rows with zone-less UTC instants and footnotes as text, for comparison."""
    wanted = names or rows.columns
    out = []
    for name in wanted:
        if name == "ts_ingested":
            instant = F.col(name)
            if dict(rows.dtypes)[name] == "string":
                instant = calendar.instant(instant)
            out.append(calendar.utc_wall_clock(instant).alias("ts"))
        elif name == "footnotes":
            out.append(F.array_join("footnotes", "|").alias("notes"))
        else:
            out.append(F.col(name))
    return rows.select(*out)
