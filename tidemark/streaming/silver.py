"""Bronze stream to silver: typed rows, latest per point within a micro-batch."""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import contracts as C
from tidemark.functions.messages import type_points
from tidemark.operators import compaction, gate
from tidemark.operators.latest import latest_by_aggregate, latest_per_key
from tidemark.sources.streams import read_files
from tidemark.streaming.runs import start
from tidemark.workspace import delete, exists, folders, hidden, publish, read_text

RUN, BATCH = "run", "batch_id"
#: Where packed epochs lie; a stream that reads the silver folder does not see them.
PACKED = "_packed"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Name of the query that a checkpoint belongs to; a cleared one gets another."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def latest_points_of(batch: DataFrame) -> DataFrame:
    return latest_per_key(batch, C.POINT_KEYS, C.POINT_RECENCY, C.POINT_TIE)


def write_silver_batch(batch: DataFrame, folder: str, root: str) -> int:
    """Write the latest points of a batch as ``folder``; how many rows came in.

    The folder appears whole or not at all, and a written one is left alone. Whether
    there was a row at all is seen while writing.
    """
    spark, seen, made = batch.sparkSession, Observation(), hidden(root)
    counted = batch.observe(seen, F.count("*").alias("rows"))
    latest_points_of(counted).write.parquet(made)
    rows = gate.figures(seen).get("rows", 0)
    if not rows or not publish(spark, made, folder):
        delete(spark, made)
    return rows


def stream_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    checkpoint: str,
    every: str | None = None,
    max_files: int | None = None,
    max_bytes: str | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Each micro-batch owns the folder ``run=<query>/batch_id=<epoch>``.

    A written folder is left alone by a replay, and a new checkpoint is another run,
    so files that a reader has planned over stay as they are. With ``archive``, bronze
    files go there once a later batch has been committed.
    """
    source = read_files(spark, bronze, C.STREAM_BRONZE_SCHEMA, max_files, max_bytes, archive)
    typed = type_points(source)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        folder = f"{silver}/{RUN}={run_of(batch.sparkSession, checkpoint)}/{BATCH}={epoch}"
        if not exists(batch.sparkSession, folder):
            write_silver_batch(batch, folder, silver)

    writer = typed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return start(writer, every)


def _places(spark: SparkSession, silver: str) -> dict[str, compaction.Place]:
    """The folders of each run."""
    found: dict[str, compaction.Place] = defaultdict(compaction.Place)
    for path in folders(spark, f"{silver}/{PACKED}/{RUN}=*/_span=*"):
        found[path.split(f"{RUN}=")[1].split("/")[0]].packed.append(compaction.Packed.at(path))
    for path in folders(spark, f"{silver}/{RUN}=*/{BATCH}=*"):
        run, epoch = path.split(f"{RUN}=")[1].split(f"/{BATCH}=")
        found[run].loose[int(epoch)] = path
    return dict(found)


def read_silver(spark: SparkSession, silver: str) -> DataFrame | None:
    """Silver rows with their epoch, packed or not; None if there are none."""
    paths = [path for place in _places(spark, silver).values() for path in place.paths()]
    if not paths:
        return None
    return compaction.read_paths(spark, paths, C.STREAM_SILVER_SCHEMA, BATCH, BATCH)


def compact_silver(
    spark: SparkSession, silver: str, keep: int = 1, target: int = compaction.TARGET
) -> list[str]:
    """Pack the epochs of each run but the newest ``keep``; the new folders."""
    made = []
    for run, place in _places(spark, silver).items():
        closed = sorted(place.loose)[: len(place.loose) - keep]
        place.loose = {epoch: place.loose[epoch] for epoch in closed}
        newest = closed[-1] if closed else -1
        root = f"{silver}/{PACKED}/{RUN}={run}"
        schema = C.STREAM_SILVER_SCHEMA
        new = compaction.pack(
            spark, place, newest, root, hidden(silver), schema, BATCH, BATCH, target
        )
        made += [new] if new else []
    return made


def expire_silver(spark: SparkSession, silver: str, keep: int = 1) -> list[str]:
    """Delete packed epochs but the newest ``keep`` of each run, and what wider packs took up.

    A stream that reads this folder must have read what goes: keep more epochs than it
    may lie behind.
    """
    stale = []
    for place in _places(spark, silver).values():
        newest = set(sorted(place.loose.values(), key=lambda p: int(p.split(f"{BATCH}=")[1]))[-keep:])
        stale += [path for path in place.expired() if path not in newest]
    for path in stale:
        delete(spark, path)
    return stale


def stream_latest_state(
    points: DataFrame, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Latest row per series over all batches, kept in the state store and nowhere else.

    ``read_latest_state`` reads it from there. State is one row per series, so a large
    run should use the RocksDB state store of the session.
    """
    latest = latest_by_aggregate(points, ("series_id",), C.POINT_RECENCY, C.SERIES_TIE)
    writer = (
        latest.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, every)


def read_latest_state(
    spark: SparkSession, checkpoint: str, epoch: int | None = None
) -> DataFrame | None:
    """The state after an epoch, by default the last committed one; None before the first."""
    if not folders(spark, f"{checkpoint}/commits/[0-9]*"):
        return None
    reader = spark.read.format("statestore")
    if epoch is not None:
        reader = reader.option("batchId", epoch)
    state = reader.load(checkpoint)
    # What is kept of a group is its newest row, before what orders it.
    newest = state.schema["value"].dataType.names[0]
    return state.select("key.*", f"value.{newest}.*")
