"""Query key to callable: every operator, run over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contracts as C
from tidemark.functions import calendar, drift, messages, typing
from tidemark.operators import gate, keyed, latest, layout, merge, serving, sketches
from tidemark.plans import batch
from tidemark.plans import standins as S
from tidemark.sources import payloads as P
from tidemark.sources import tables
from tidemark.sources.streams import read_files
from tidemark.streaming import bronze, gold, runs, silver
from tidemark.workspace import ensure_folder, folders, new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT_COLUMNS = ("event_id", "user_id", "event_type", "ts", "value")
PAIR = ("user_id", "event_type")
INGEST_DAY = dt.date(2024, 1, 31)
SINCE = dt.datetime(1997, 1, 1)
UNTIL = dt.datetime(2000, 12, 31)
FIRST_FEED = ("view", "click", "signup")
PERIOD_CONTRACT = C.Contract("period", keys=("o_orderkey",), required=("m", "dt"))


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return S.table(spark, sf, "events")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return S.table(spark, sf, "orders")


# Column functions


@query
def decode_json_props(spark, sf):
    return _events(spark, sf).select("event_id", F.from_json("props", "k int").k.alias("k"))


@query
def flag_tristate(spark, sf):
    raw = S.fact_raw(_orders(spark, sf))
    return raw.select(
        F.col("error_data").cast("long").alias("o_orderkey"),
        typing.flag_or_null(F.col("seasonally_adj")).alias("flag"),
    )


@query
def flag_default_false(spark, sf):
    raw = S.fact_raw(_orders(spark, sf))
    return raw.select(
        F.col("error_data").cast("long").alias("o_orderkey"),
        typing.flag_or_false(F.col("seasonally_adj")).alias("flag"),
    )


@query
def numeric_clean(spark, sf):
    raw = S.fact_raw(_orders(spark, sf))
    return raw.select(
        typing.integer(F.col("error_data")).alias("o_orderkey"),
        typing.amount(F.col("cell_value")).alias("v"),
        typing.amount(F.col("seasonally_adj")).alias("not_a_number"),
    )


@query
def year_month_date(spark, sf):
    raw = S.fact_raw(_orders(spark, sf))
    day = calendar.year_month_to_date(F.col("time"))
    return raw.select(
        F.col("error_data").cast("long").alias("o_orderkey"),
        day.alias("dt"),
        F.year(day).alias("y"),
        F.month(day).alias("m"),
    )


def _period_frame(spark, sf):
    day = F.col("o_orderdate")
    code = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "M13")
        .when(F.col("o_orderpriority") == "5-LOW", "Q01")
        .otherwise(F.concat(F.lit("M"), F.date_format(day, "MM")))
    )
    coded = _orders(spark, sf).select("o_orderkey", F.year(day).alias("y"), code.alias("period"))
    month = calendar.period_to_month(F.col("period"))
    return coded.select(
        "o_orderkey",
        month.alias("m"),
        calendar.first_of_month(F.col("y"), month).alias("dt"),
    )


@query
def period_month(spark, sf):
    return _period_frame(spark, sf)


@query
def parse_timestamp(spark, sf):
    text = F.when(F.col("event_type") == "error", "nope").otherwise(
        calendar.iso_text(F.col("ts"))
    )
    return _events(spark, sf).select(
        "event_id", calendar.utc_wall_clock(calendar.instant(text)).alias("ts")
    )


@query
def footnote_texts(spark, sf):
    kind, props = F.col("event_type"), F.col("props")
    keyed = F.create_map(F.lit("code"), kind, F.lit("text"), props)
    no_text = F.create_map(F.lit("code"), kind, F.lit("text"), F.lit(None).cast("string"))
    empty = F.create_map().cast("map<string,string>")
    notes = (
        F.when(kind == "view", F.array(empty))
        .when(kind == "click", F.lit(None).cast("array<map<string,string>>"))
        .when(kind == "error", F.array(empty, no_text, keyed))
        .otherwise(F.array(keyed, empty))
    )
    texts = messages.footnote_texts(notes)
    return _events(spark, sf).select(
        "event_id",
        F.size(texts).alias("n"),
        F.get(texts, F.lit(0)).alias("first_text"),
        F.get(texts, F.lit(1)).alias("second_text"),
    )


# Payloads and messages


@query
def tabular_payload_records(spark, sf):
    return P.tabular_records(S.tabular_payloads(_orders(spark, sf)), C.FACT_RAW_COLUMNS)


def _shown_points(points):
    return points.select(
        "seriesID",
        "year",
        "period",
        "periodName",
        typing.number(F.col("value")).alias("value"),
        "latest",
        F.array_join(messages.footnote_texts(F.col("footnotes")), "|").alias("notes"),
    )


@query
def payload_all_points(spark, sf):
    return _shown_points(P.all_points(S.nested_payloads(_events(spark, sf))))


@query
def payload_latest_point(spark, sf):
    return _shown_points(P.latest_points(S.nested_payloads(_events(spark, sf))))


@query
def encode_messages(spark, sf):
    encoded = messages.encode_points(
        S.points(_events(spark, sf)), calendar.iso_text(F.col("ts"))
    )
    return encoded.select(
        "key", F.from_json("value", C.MESSAGE_SCHEMA).alias("j")
    ).select(
        "key",
        "j.ts_ingested",
        "j.series_id",
        F.col("j.year").cast("int").alias("year"),
        "j.period",
        F.col("j.value").cast("double").alias("value"),
        F.array_join("j.footnotes", "|").alias("notes"),
        F.col("j.is_latest").cast("boolean").alias("is_latest"),
    )


@query
def publish_window(spark, sf):
    """Points of some series and years, as they are published."""
    root = new_folder(spark, "published")
    bronze.publish_points(
        S.nested_payloads(_events(spark, sf)),
        latest_only=False,
        ts_ingested=F.lit("2024-01-31T00:00:00+00:00"),
        sink_format="parquet",
        sink_options={"path": root},
        series=[str(i) for i in range(1, 100)],
        first_year=2000,
        last_year=2030,
    )
    return spark.read.parquet(root).select("key", F.get_json_object("value", "$.value").cast("double").alias("value"))


@query
def decode_messages(spark, sf):
    encoded = S.messages(_events(spark, sf))
    broken = F.col("key").cast("string").endswith(S.OTHER_PERIOD)
    return S.shown(messages.decode_messages(S.with_corrupt(encoded, broken)))


@query
def undeclared_fields(spark, sf):
    """Message bodies with fields that the message schema does not know, next to known ones."""
    props = F.from_json("props", "k int").k
    more = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("series_id"),
        F.col("value").cast("string").alias("value"),
        props.alias("revision"),
        F.when(F.col("event_type") == "view", F.struct(F.col("event_type").alias("feed"))).alias("origin"),
    ))
    body = F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(more)
    rows = _events(spark, sf).select("event_id", body.alias("body"))
    found = drift.with_undeclared(rows, "body", C.MESSAGE_SCHEMA.names)
    return found.select("event_id", F.col("extra_revision").alias("revision"), F.col("extra_origin.feed").alias("feed"))


@query
def select_window(spark, sf):
    return tables.select_window(
        _orders(spark, sf),
        "o_orderdate",
        columns=("o_orderkey", "o_orderpriority", "o_totalprice"),
        since=SINCE,
        until=UNTIL,
        series_column="o_orderpriority",
        series=("1-URGENT", "2-HIGH", "3-MEDIUM"),
    )


# Latest per key


@query
def latest_per_key(spark, sf):
    rows = _events(spark, sf).select(*EVENT_COLUMNS)
    return latest.latest_per_key(rows, PAIR, ("ts",), ("event_id",))


@query
def latest_per_series(spark, sf):
    rows = _events(spark, sf).select(*EVENT_COLUMNS)
    return latest.latest_per_key(rows, ("user_id",), ("ts",), ("event_id",))


@query
def latest_per_fact_key(spark, sf):
    valid = gate.valid_rows(S.gold_rows(_orders(spark, sf)), C.FACT)
    return latest.latest_by_aggregate(valid, C.FACT.keys, C.FACT_RECENCY, C.FACT_TIE)


@query
def drop_duplicates(spark, sf):
    return latest.drop_repeats(_events(spark, sf).select(*PAIR), PAIR)


@query
def drop_duplicates_newest(spark, sf):
    return latest.drop_repeats(_events(spark, sf).select(*EVENT_COLUMNS), PAIR, ("ts", "event_id"))


@query
def distinct_on_latest(spark, sf):
    rows = _events(spark, sf).select("user_id", "event_id", "ts")
    return latest.as_of_latest(rows, ("user_id",), ("ts",), ("event_id",))


# Merge and contract


def _feeds(spark, sf):
    """Two feeds of one table, each with its latest row per user."""
    rows = _events(spark, sf).select(*EVENT_COLUMNS)
    first = F.col("event_type").isin(*FIRST_FEED)

    def newest(feed):
        return latest.latest_per_key(feed, ("user_id",), ("ts",), ("event_id",))

    return newest(rows.where(first)), newest(rows.where(~first))


@query
def upsert_snapshot(spark, sf):
    root = new_folder(spark, "upsert")
    for feed in _feeds(spark, sf):
        keyed.append(spark, root, feed, ("user_id",))
    keyed.fold(spark, root, ("user_id",))
    return keyed.read(spark, root, ("user_id",)).select(*EVENT_COLUMNS)


@query
def upsert_latest_unguarded(spark, sf):
    base, delta = _feeds(spark, sf)
    return merge.upsert(base, delta, ("user_id",))


@query
def upsert_latest_guarded(spark, sf):
    base, delta = _feeds(spark, sf)
    return merge.upsert(base, delta, ("user_id",), ("ts",), ("event_id",))


@query
def history_insert_if_absent(spark, sf):
    rows = _events(spark, sf).select(*EVENT_COLUMNS)

    def newest(part):
        return latest.latest_per_key(part, PAIR, ("ts",), ("event_id",))

    held = newest(rows.where(S.shift() < 2))
    delta = newest(rows.where(S.shift() > 0))
    return held.unionByName(merge.insert_if_absent(held, delta, PAIR))


@query
def history_conflict_staged(spark, sf):
    """As history_insert_if_absent, in the form of the job: both sides read from disk."""
    root = new_folder(spark, "conflict")
    rows = _events(spark, sf).select(*EVENT_COLUMNS)
    parts = {"held": rows.where(S.shift() < 2), "staged": rows.where(S.shift() > 0)}
    for name, part in parts.items():
        latest.latest_per_key(part, PAIR, ("ts",), ("event_id",)).write.parquet(f"{root}/{name}")
    held, staged = (spark.read.parquet(f"{root}/{name}") for name in parts)
    new = merge.insert_if_absent_staged(held, staged, PAIR).select(*EVENT_COLUMNS)
    return held.unionByName(new)


@query
def quality_gate_valid(spark, sf):
    return gate.valid_rows(_period_frame(spark, sf), PERIOD_CONTRACT)


@query
def quality_gate_rejects(spark, sf):
    return gate.rejected_rows(_period_frame(spark, sf), PERIOD_CONTRACT).select(
        "o_orderkey", gate.REASON
    )


@query
def fact_rejects(spark, sf):
    rejected = gate.rejected_rows(S.gold_rows(_orders(spark, sf)), C.FACT)
    return rejected.select(F.col("error_data").alias("order_text"), gate.REASON)


@query
def duplicate_keys(spark, sf):
    return gate.duplicate_keys(_events(spark, sf), PAIR)


# Storage


@query
def jsonl_roundtrip(spark, sf):
    rows = _events(spark, sf)
    path = new_folder(spark, "jsonl")
    layout.write_jsonl(rows, path)
    return tables.read_jsonl(spark, path, rows.schema)


@query
def partition_append_scan(spark, sf):
    rows = _orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = new_folder(spark, "append")
    final = F.col("o_orderstatus") == "F"
    layout.append_ingest(rows.where(final), path, INGEST_DAY)
    layout.append_ingest(rows.where(~final), path, INGEST_DAY + dt.timedelta(days=1))
    return tables.read_partitioned(spark, path)


@query
def partition_window_scan(spark, sf):
    """A window of a table with one folder per month; the others are not listed."""
    rows = _orders(spark, sf).withColumn("ingest_date", F.trunc("o_orderdate", "month"))
    path = new_folder(spark, "window")
    layout.write_partitioned(rows, path, ["ingest_date"])
    return tables.read_partitioned(spark, path, "ingest_date", "1997-03-01", "1998-02-15")


@query
def partition_overwrite(spark, sf):
    rows = _orders(spark, sf).withColumns(
        {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    )
    path = new_folder(spark, "overwrite")
    layout.write_partitioned(rows, path, layout.partition_columns(rows))
    return tables.read_partitioned(spark, path)


@query
def clustered_layout(spark, sf):
    """The whole table written in Z-order of day and category."""
    path = new_folder(spark, "clustered")
    layout.write_clustered(_orders(spark, sf), path, ["o_orderdate", "o_orderpriority"], 16)
    return spark.read.parquet(path)


@query
def schema_fallback(spark, sf):
    path = f"{sf}/orders.parquet"
    missing = tables.schema_or(spark, new_folder(spark, "absent"), C.FACT_RAW_SCHEMA)
    if missing != C.FACT_RAW_SCHEMA:
        raise ValueError("an absent folder must give the fallback schema")
    return spark.read.schema(tables.schema_or(spark, path, missing)).parquet(path)


# Batch path


@query
def job_batch_bronze(spark, sf):
    root = new_folder(spark, "bronze")
    S.tabular_payloads(_orders(spark, sf)).write.text(f"{root}/payloads")
    payloads = P.read_payloads(spark, f"{root}/payloads", one_per_line=True)
    batch.land_payloads(spark, payloads, f"{root}/raw", f"{root}/bronze", INGEST_DAY)
    return tables.read_partitioned(spark, f"{root}/bronze")


@query
def bronze_to_silver(spark, sf):
    return batch.bronze_to_silver(S.fact_raw(_orders(spark, sf)))


@query
def silver_to_gold(spark, sf):
    root = new_folder(spark, "gold")
    layout.write_partitioned(S.fact_raw(_orders(spark, sf)), f"{root}/bronze", ["ingest_date"])
    batch.build_silver(spark, f"{root}/bronze", f"{root}/silver")
    batch.build_gold(spark, f"{root}/silver", f"{root}/gold")
    return batch.read_gold(spark, f"{root}/gold")


def _fact(spark, sf):
    return batch.fact_delta(S.gold_rows(_orders(spark, sf)))


@query
def fact_latest(spark, sf):
    return serving.fact_latest(_fact(spark, sf))


@query
def fact_latest_maintained(spark, sf):
    """The view kept by changes only, over three arrivals of ingest months, the last after a fold."""
    root = new_folder(spark, "view")
    layout.write_partitioned(S.fact_raw(_orders(spark, sf)), f"{root}/bronze", ["ingest_date"])
    batch.build_silver(spark, f"{root}/bronze", f"{root}/silver")
    cuts = [None, dt.date(1997, 1, 1), dt.date(1999, 1, 1), None]
    for i, (first, after) in enumerate(zip(cuts, cuts[1:])):
        last = after and after - dt.timedelta(days=1)
        batch.build_gold(spark, f"{root}/silver", f"{root}/gold", first, str(i), last)
        if i == 2:
            batch.fold_gold(spark, f"{root}/gold")
            keyed.expire(spark, f"{root}/gold")
        batch.refresh_fact_latest(spark, f"{root}/gold", f"{root}/view")
    return batch.read_fact_latest(spark, f"{root}/view")


@query
def series_monthly(spark, sf):
    return serving.series_monthly(_fact(spark, sf))


@query
def dim_date(spark, sf):
    return serving.dim_date(_orders(spark, sf), "o_orderdate")


def _decoded(spark, sf):
    return messages.decode_messages(S.messages(_events(spark, sf)))


def _valid_serving(spark, sf):
    points = silver.latest_points_of(messages.type_points(_decoded(spark, sf)))
    return gate.valid_rows(gold.serving_rows(points), C.SERIES_LATEST)


@query
def latest_view(spark, sf):
    return S.shown(serving.series_latest(gold.latest_series_of(_valid_serving(spark, sf))))


@query
def database_staging_rows(spark, sf):
    rows = layout.database_columns(gold.latest_series_of(_valid_serving(spark, sf)))
    return rows.withColumn("ts_ingested", calendar.utc_wall_clock(F.col("ts_ingested")))


@query
def gold_counts(spark, sf):
    return serving.row_counts(
        fact=_fact(spark, sf),
        series_latest=gold.latest_series_of(_valid_serving(spark, sf)),
    )


# Streaming path


@query
def stream_bronze(spark, sf):
    root = new_folder(spark, "bronze")
    source = S.messages(S.event_stream(spark, sf))
    runs.wait(bronze.stream_bronze(source, f"{root}/bronze", f"{root}/checkpoint"))
    return S.shown(spark.read.parquet(f"{root}/bronze"))


def _arrivals(spark, sf, root):
    """Bronze rows of each shift in turn; decoded once, together all of the events."""
    shift = S.shift(calendar.utc_wall_clock(calendar.instant(F.col("ts_ingested"))))
    rows = _decoded(spark, sf).withColumn("shift", shift)
    rows.write.partitionBy("shift").parquet(f"{root}/arrivals")
    for arrival in S.SHIFTS:
        yield spark.read.schema(C.STREAM_BRONZE_SCHEMA).parquet(f"{root}/arrivals/shift={arrival}")


def _run_silver(spark, root):
    runs.wait(
        silver.stream_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoint")
    )


@query
def stream_silver_latest(spark, sf):
    root = new_folder(spark, "silver")
    for arrival in _arrivals(spark, sf, root):
        arrival.write.mode("append").parquet(f"{root}/bronze")
        _run_silver(spark, root)
    return S.shown(spark.read.parquet(f"{root}/silver").drop(silver.RUN))


@query
def stream_restart(spark, sf):
    root = new_folder(spark, "restart")
    _decoded(spark, sf).write.parquet(f"{root}/bronze")
    _run_silver(spark, root)
    _run_silver(spark, root)
    return S.shown(spark.read.parquet(f"{root}/silver").drop(silver.RUN))


@query
def stream_empty_source(spark, sf):
    root = new_folder(spark, "empty")
    ensure_folder(spark, f"{root}/bronze")
    _run_silver(spark, root)
    _decoded(spark, sf).write.mode("append").parquet(f"{root}/bronze")
    _run_silver(spark, root)
    return S.shown(spark.read.parquet(f"{root}/silver").drop(silver.RUN))


def _run_gold(spark, sf, guard_recency=True, fresh_from=9):
    """Gold over three arrivals; each is one epoch. From ``fresh_from`` on, a new checkpoint."""
    root = new_folder(spark, "gold")
    for epoch, arrival in enumerate(_arrivals(spark, sf, root)):
        part = silver.latest_points_of(messages.type_points(arrival))
        part.write.parquet(f"{root}/silver/{silver.BATCH}={epoch}")
        checkpoint = f"{root}/checkpoint-{epoch >= fresh_from}"
        runs.wait(
            gold.stream_gold(
                spark, f"{root}/silver", f"{root}/gold", checkpoint, guard_recency=guard_recency
            )
        )
    return f"{root}/gold"


@query
def stream_gold_history(spark, sf):
    """The versions of three epochs are 1, 2 and 3."""
    rows = gold.read_history(spark, _run_gold(spark, sf))
    return S.shown(rows.withColumn("batch_id", F.col("version") - 1).drop("version"))


@query
def stream_history_after_reset(spark, sf):
    """The third arrival comes under a new checkpoint, which reads all of silver again."""
    rows = gold.read_history(spark, _run_gold(spark, sf, fresh_from=2))
    return S.shown(rows.drop("version"))


@query
def stream_gold_latest(spark, sf):
    return S.shown(gold.read_latest(spark, _run_gold(spark, sf)))


@query
def stream_gold_after_reset(spark, sf):
    """A cleared checkpoint reads all of silver again: nothing is lost or hidden."""
    return S.shown(gold.read_latest(spark, _run_gold(spark, sf, fresh_from=2)))


@query
def stream_gold_latest_unguarded(spark, sf):
    return S.shown(gold.read_latest(spark, _run_gold(spark, sf, guard_recency=False)))


@query
def history_compacted(spark, sf):
    """History of three epochs whose closed days are packed, while a fourth lies open; then expired."""
    root = _run_gold(spark, sf)
    gold.fold_latest(spark, root)
    gold.compact_history(spark, root)
    gold.expire_gold(spark, root)
    rows = gold.read_history(spark, root)
    return S.shown(rows.withColumn("batch_id", F.col("version") - 1).drop("version"))


@query
def sketched_counts(spark, sf):
    """Series and rows of three epochs by their merged sketches, held against the tables.

    ``n`` is exact; ``within`` tells whether the sketch is as near as it says, by three
    standard errors of the distinct count, and by the rank error of the median.
    """
    root = _run_gold(spark, sf)
    found = gold.read_sketched(spark, root).first()
    series = gold.read_latest(spark, root).count()
    silver_rows = spark.read.parquet(f"{root}/../silver")
    valid = gate.valid_rows(gold.serving_rows(silver_rows), C.SERIES_HISTORY)
    ranks = valid.agg(
        F.count("*").alias("n"),
        (F.count_if(F.col("value") < found.quantiles[0]) / F.count("*")).alias("low"),
        (F.count_if(F.col("value") <= found.quantiles[0]) / F.count("*")).alias("high"),
    )
    near = abs(found["keys"] - series) <= 3 * sketches.DISTINCT_ERROR * series
    off = F.lit(sketches.RANK_ERROR)
    values = ranks.select(
        F.lit("values").alias("measure"),
        "n",
        ((F.col("low") - off <= 0.5) & (F.col("high") + off >= 0.5) & (F.col("n") == found.numbers)).alias("within"),
    )
    return values.unionByName(spark.createDataFrame([("series", series, near)], values.schema))


@query
def silver_compacted(spark, sf):
    """Silver of three epochs, the first two packed and expired."""
    root = new_folder(spark, "silver")
    for arrival in _arrivals(spark, sf, root):
        arrival.write.mode("append").parquet(f"{root}/bronze")
        _run_silver(spark, root)
    silver.compact_silver(spark, f"{root}/silver")
    silver.expire_silver(spark, f"{root}/silver")
    return S.shown(silver.read_silver(spark, f"{root}/silver"))


@query
def stream_archived_source(spark, sf):
    """Silver over three arrivals; bronze files that were read go to an archive.

    The rows are those of silver; each says how many arrivals left the source.
    """
    root = new_folder(spark, "archived")
    for arrival in _arrivals(spark, sf, root):
        arrival.coalesce(1).write.mode("append").parquet(f"{root}/bronze")
        runs.wait(
            silver.stream_silver(
                spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoint",
                archive=f"{root}/archive",
            )
        )
    left = len(folders(spark, f"{root}/bronze/*.parquet"))
    rows = silver.read_silver(spark, f"{root}/silver")
    return S.shown(rows).withColumn("archived", F.lit(len(S.SHIFTS) - left))


def _run_state(spark, sf):
    """State over three arrivals, one after the other."""
    root = new_folder(spark, "state")
    for arrival in _arrivals(spark, sf, root):
        arrival.write.mode("append").parquet(f"{root}/bronze")
        source = read_files(spark, f"{root}/bronze", C.STREAM_BRONZE_SCHEMA)
        runs.wait(silver.stream_latest_state(messages.type_points(source), f"{root}/checkpoint"))
    return f"{root}/checkpoint"


def _shown_state(rows):
    return S.shown(rows, "series_id", "ts_ingested", "year", "period", "periodName", "value")


@query
def stream_state_latest(spark, sf):
    return _shown_state(silver.read_latest_state(spark, _run_state(spark, sf)))


@query
def stream_state_read(spark, sf):
    """The state as it was after the second of three arrivals."""
    return _shown_state(silver.read_latest_state(spark, _run_state(spark, sf), epoch=1))


@query
def gate_metrics(spark, sf):
    """Rows and rejects by reason of the fact run, as they were measured while it was written."""
    root = new_folder(spark, "metrics")
    layout.write_partitioned(S.fact_raw(_orders(spark, sf)), f"{root}/bronze", ["ingest_date"])
    batch.build_silver(spark, f"{root}/bronze", f"{root}/silver")
    seen = batch.build_gold(spark, f"{root}/silver", f"{root}/gold")
    figures = [("rows", seen.rows), ("valid", seen.valid), *sorted(seen.rejects.items())]
    return spark.createDataFrame(figures, "measure string, n long")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest valid value per series and period, from raw JSON messages."""
    return S.shown(_valid_serving(spark, sf_dir))
