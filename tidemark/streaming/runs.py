"""Starting and ending streaming queries."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Default trigger interval and time bound of the layers, in seconds.
BRONZE_SECONDS, BRONZE_BOUND = 10, 60
SILVER_SECONDS, SILVER_BOUND = 5, 90
GOLD_SECONDS, GOLD_BOUND = 5, 90


def start(writer: DataStreamWriter, every: str | None) -> StreamingQuery:
    """Run on an interval, or with ``every=None`` drain what is there and end."""
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def wait(query: StreamingQuery, max_seconds: int = 0) -> None:
    """Wait at most ``max_seconds`` and stop; zero or less waits until the query ends."""
    if max_seconds > 0:
        query.awaitTermination(max_seconds)
        query.stop()
    else:
        query.awaitTermination()
