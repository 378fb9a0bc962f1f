"""Silver stream to gold: a history of arrivals and the latest row per series.

A micro-batch is one step of a keyed table (see ``keyed``): the newest valid row of
every series as changes of the latest table, those whose key the history does not
hold yet, and the rejected rows. One rename publishes all three, so they never
disagree. A repeated epoch is skipped, and a new checkpoint goes on where the table
stands. An epoch reads its batch once and writes what it brings; days that are
closed are packed by ``compact_history``.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import contracts as C
from tidemark.functions import calendar
from tidemark.operators import compaction, gate, keyed, merge, sketches
from tidemark.operators.latest import latest_per_key
from tidemark.operators.layout import rebalance
from tidemark.sources.streams import read_files
from tidemark.streaming.runs import start
from tidemark.streaming.silver import run_of
from tidemark.workspace import delete, folders, hidden

DAY, HISTORY, VERSION = "ingest_day", "history", "version"
#: Days between the first and the last of a batch up to which their folders are named one by one.
NAMED_DAYS = 400
KEYS = ("series_id",)
OnBatch = Callable[[DataFrame, int], None]
OnMeasures = Callable[[gate.Measures, int], None]
LATEST_ORDER = ("ts_ingested", "year", "period", "value", "periodname", "is_latest", "footnotes")


def serving_rows(silver: DataFrame) -> DataFrame:
    """Fixed column order of the serving tables."""
    return silver.withColumnRenamed("periodName", "periodname").select(*C.SERVING_COLUMNS)


def latest_series_of(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, ("series_id",), LATEST_ORDER[:1], LATEST_ORDER[1:])


def _places(
    spark: SparkSession, gold: str, first: dt.date | None = None, last: dt.date | None = None
) -> dict[str, compaction.Place]:
    """The folders of each day, of all days or of those between two; others are not listed."""
    days = "*"
    if first is not None and (last - first).days < NAMED_DAYS:
        named = (first + dt.timedelta(days=i) for i in range((last - first).days + 1))
        days = "{" + ",".join(day.isoformat() for day in named) + "}"
    found: dict[str, compaction.Place] = defaultdict(compaction.Place)
    for path in folders(spark, f"{gold}/{HISTORY}/{DAY}={days}/_span=*"):
        found[path.split(f"{DAY}=")[1].split("/")[0]].packed.append(compaction.Packed.at(path))
    steps = f"{gold}/steps/{keyed.STAMP}=*/{keyed.RUN}=*/{keyed.STEP}=*"
    for path in folders(spark, f"{steps}/{keyed.KIND}={HISTORY}/{DAY}={days}"):
        found[path.split(f"{DAY}=")[1]].loose[keyed.number_of(path)] = path
    return dict(found)


def _read_places(spark: SparkSession, places: dict[str, compaction.Place]) -> DataFrame | None:
    paths = [path for place in places.values() for path in place.paths()]
    if not paths:
        return None
    return compaction.read_paths(spark, paths, C.SERVING_SCHEMA, VERSION, keyed.STAMP)


def write_new_history(
    spark: SparkSession, gold: str, staged: str, span: dict, folder: str
) -> None:
    """The staged rows whose (series, instant) is not held yet.

    The instant is part of the key, so only the days of the batch are looked up, and
    of them, where the batch is too large to broadcast, what a Bloom filter lets pass.
    """
    spark = merge.with_runtime_filters(spark)
    rows = staged = spark.read.parquet(staged).select(*C.SERVING_COLUMNS)
    keys = C.SERIES_HISTORY.keys
    held = _read_places(spark, _places(spark, gold, span["first_day"], span["last_day"]))
    if held is not None:
        rows = merge.insert_if_absent_staged(held, staged, keys).select(*staged.columns)
    rows = rows.withColumn(DAY, _utc_day())
    rebalance(rows, (DAY,)).write.partitionBy(DAY).parquet(folder)


def _utc_day():
    return calendar.utc_wall_clock(F.col("ts_ingested")).cast("date")


def write_gold_batch(
    batch: DataFrame,
    epoch: int,
    gold: str,
    guard_recency: bool = True,
    on_batch: OnBatch | None = None,
    run: str | None = None,
    fold_every: int = keyed.FOLD_EVERY,
) -> gate.Measures | None:
    """History, latest and rejects of one micro-batch; a published (run, epoch) is skipped.

    The batch is read once: its rejected rows and the newest of the others come out of
    one ranking, and what it measured is taken in flight and returned (None if skipped).
    """
    spark = batch.sparkSession
    keyed.settle_order(spark, gold, LATEST_ORDER if guard_recency else ())
    if run is not None and keyed.is_published(spark, gold, run, epoch):
        if on_batch is not None:
            again = f"{gold}/steps/*/{keyed.RUN}={run}/{keyed.STEP}={epoch}/{keyed.KIND}={keyed.CHANGES}"
            if folders(spark, again):
                on_batch(spark.read.parquet(again).select(*C.SERVING_COLUMNS), epoch)
        return None
    made, inside = keyed.prepare(gold, run, epoch)
    valid = gate.is_valid(C.SERIES_HISTORY)
    sketched = sketches.aggregates(*(F.when(valid, F.col(c)) for c in ("series_id", "value")))
    rows, measure = gate.measured(
        serving_rows(batch),
        C.SERIES_HISTORY,
        first_day=F.min(_utc_day()),
        last_day=F.max(_utc_day()),
        **sketched,
    )
    newest = gate.newest_or_rejected(
        rows, C.SERIES_HISTORY, KEYS, LATEST_ORDER[:1], LATEST_ORDER[1:]
    )
    kind = F.when(F.col(gate.REASON).isNull(), keyed.CHANGES).otherwise(keyed.REJECTS)
    newest.withColumn(keyed.KIND, kind).write.partitionBy(keyed.KIND).parquet(inside)
    seen = measure()
    if not seen.rows:
        delete(spark, made)
        return seen
    changes = f"{inside}/{keyed.KIND}={keyed.CHANGES}"
    if seen.valid:
        sketches.write(spark, seen.valid, seen.more, f"{inside}/{keyed.KIND}={keyed.SKETCHES}")
        write_new_history(spark, gold, changes, seen.more, f"{inside}/{keyed.KIND}={HISTORY}")
    stamp = keyed.publish_step(spark, gold, made)
    if on_batch is not None and seen.valid:
        published = changes.replace(made, f"{gold}/steps/{keyed.STAMP}={stamp}")
        on_batch(spark.read.parquet(published).select(*C.SERVING_COLUMNS), epoch)
    keyed.fold_if_due(spark, gold, KEYS, stamp, fold_every)
    return seen


def stream_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    checkpoint: str,
    every: str | None = None,
    max_files: int | None = None,
    max_bytes: str | None = None,
    guard_recency: bool = True,
    on_batch: OnBatch | None = None,
    fold_every: int = keyed.FOLD_EVERY,
    on_measures: OnMeasures | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Serve silver as history and latest.

    ``guard_recency=False`` lets a late older row replace a newer one, as a plain
    database upsert does; it is fixed by a table's first batch. ``on_batch`` gets the
    staged rows and the epoch after the commit, for example to copy them to a
    database; it may see an epoch twice, and only the last one of a run again.
    ``on_measures`` gets what an epoch measured: rows, and rejects by reason. With
    ``archive``, silver files go there once a later epoch has been committed.
    """

    def write_batch(batch: DataFrame, epoch: int) -> None:
        run = run_of(spark, checkpoint)
        seen = write_gold_batch(batch, epoch, gold, guard_recency, on_batch, run, fold_every)
        if on_measures is not None and seen is not None:
            on_measures(seen, epoch)

    rows = read_files(spark, silver, C.STREAM_SILVER_SCHEMA, max_files, max_bytes, archive)
    writer = rows.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return start(writer, every)


def read_history(
    spark: SparkSession, gold: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame | None:
    """History with the step that brought each row; with two days, only those between are listed."""
    history = _read_places(spark, _places(spark, gold, first, last))
    return None if history is None else history.select(*C.SERVING_COLUMNS, VERSION)


def read_sketched(spark: SparkSession, gold: str, ranks=(0.5,)) -> DataFrame | None:
    """Valid rows that ever came, about how many series they have, and quantiles of their values."""
    kept = keyed.read_kept(spark, gold, keyed.SKETCHES)
    return None if kept is None else sketches.merged(kept, ranks)


def read_latest(spark: SparkSession, gold: str) -> DataFrame | None:
    latest = keyed.read(spark, gold, KEYS)
    return None if latest is None else latest.select(*C.SERVING_COLUMNS)


def fold_latest(spark: SparkSession, gold: str) -> None:
    keyed.fold(spark, gold, KEYS)


def compact_history(
    spark: SparkSession,
    gold: str,
    before: dt.date | None = None,
    target: int = compaction.TARGET,
) -> list[str]:
    """Pack the closed days of the history: those before a day, else all but the newest.

    Rows that come later for such a day are packed by the next call. The new folders.
    """
    newest = max([0, *keyed.stamps(spark, gold)])
    places = _places(spark, gold)
    closed = sorted(places)[:-1] if before is None else sorted(d for d in places if d < str(before))
    made = []
    for day in closed:
        place = places[day]
        place.loose = {n: path for n, path in place.loose.items() if n <= newest}
        root = f"{gold}/{HISTORY}/{DAY}={day}"
        new = compaction.pack(
            spark, place, newest, root, hidden(gold), C.SERVING_SCHEMA, VERSION, keyed.STAMP, target
        )
        made += [new] if new else []
    return made


def expire_gold(spark: SparkSession, gold: str, keep: int = 1) -> list[str]:
    """Delete what a base and the packed history have taken up; see ``keyed.expire``."""
    places = _places(spark, gold).values()
    open_ = {n for place in places for n in place.open()}
    stale = [path for place in places for path in place.expired() if f"/{HISTORY}/" in path]
    for path in stale:
        delete(spark, path)
    return stale + keyed.expire(spark, gold, keep, open_.__contains__)
