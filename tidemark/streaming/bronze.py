"""Publishing points as messages, and landing messages as bronze files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.messages import decode_messages, encode_points
from tidemark.sources.payloads import choose_points
from tidemark.streaming.runs import start


def publish_points(
    payloads: DataFrame,
    latest_only: bool,
    ts_ingested: Column | None = None,
    sink_format: str = "kafka",
    sink_options: dict[str, str] | None = None,
    series: Sequence[str] | None = None,
    first_year: int | None = None,
    last_year: int | None = None,
) -> None:
    """Encode the chosen points of landed payloads and send them from the executors."""
    points = choose_points(
        payloads, latest_only, series=series, first_year=first_year, last_year=last_year
    )
    messages = encode_points(points, ts_ingested)
    messages.write.format(sink_format).options(**(sink_options or {})).mode("append").save()


def stream_bronze(
    messages: DataFrame, bronze: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Decode a stream of ``key, value`` messages into Parquet files, exactly once."""
    writer = (
        decode_messages(messages)
        .writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .outputMode("append")
    )
    return start(writer, every)
