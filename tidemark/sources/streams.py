"""Stream readers. The message broker's connector must be on the session's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.workspace import ensure_folder

STARTS = ("latest", "earliest")


def bootstrap_servers(
    explicit: str | None = None, environment: str | None = None, configured: str | None = None
) -> str:
    """The first of caller, environment and configuration that names a broker."""
    chosen = explicit or environment or configured
    if not chosen:
        raise ValueError("no bootstrap servers given")
    return chosen


def kafka_options(
    bootstrap: str, topic: str, starting: str = "latest", max_offsets: int | None = None
) -> dict[str, str]:
    """Options of one-topic consumption; ``starting`` matters on a first run only.

    ``max_offsets`` bounds a micro-batch when a backlog is drained.
    """
    if starting not in STARTS:
        raise ValueError(f"starting must be one of {STARTS}")
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_sink_options(bootstrap: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": "all"}


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
    archive: str | None = None,
    max_age: str | None = None,
) -> DataFrame:
    """Parquet files of ``path`` as a stream with a declared schema.

    The folder is created if absent, so a job may start before its upstream.
    ``max_files`` or ``max_bytes`` bounds a micro-batch when a backlog is drained;
    one file per batch is ``max_files=1``. With ``archive``, files go to that folder,
    under their own path, after a batch behind theirs is committed, so that the source
    folder and its listings stay small; one source folder may have one such reader only.
    Files older than ``max_age`` against the newest are not read any more.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("give max_files or max_bytes, not both")
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_age is not None:
        reader = reader.option("maxFileAge", max_age)
    return reader.parquet(ensure_folder(spark, path))
