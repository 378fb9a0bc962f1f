"""What a merge of keyed rows means; ``keyed`` applies it to a table on disk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key

INCOMING = "_incoming"


def upsert(
    base: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str] = (),
    tie: Sequence[str] = (),
) -> DataFrame:
    """``base`` with the rows of ``delta`` put in; both hold one row per key.

    Without ``recency`` the incoming row always wins, an older one too. With it
    the newer row wins, and the incoming one when both are equal. One shuffle.
    """
    if INCOMING in base.columns:
        raise ValueError(f"{INCOMING} is a reserved column name")
    tagged = base.withColumn(INCOMING, F.lit(0)).unionByName(delta.withColumn(INCOMING, F.lit(1)))
    order = [*recency, *tie, INCOMING]
    return latest_per_key(tagged, keys, order, order).drop(INCOMING)


def insert_if_absent(held: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``delta`` whose key is not held yet; append them to the table."""
    return delta.join(held.select(*keys), list(keys), "left_anti")


def with_runtime_filters(spark: SparkSession, least: str = "256m", most: str = "1g") -> SparkSession:
    """A session that filters a scan of ``least`` bytes by a Bloom filter of the other side's keys.

    Spark's own limits leave out the case that matters here: a staged side too large
    to broadcast, but of no more than ``most`` bytes of keys.
    """
    session = spark.newSession()
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    settings = {
        "enabled": "true",
        "applicationSideScanSizeThreshold": least,
        "creationSideThreshold": most,
    }
    for name, value in settings.items():
        session.conf.set(f"{prefix}.{name}", value)
    return session


def insert_if_absent_staged(
    held: DataFrame, staged: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """:func:`insert_if_absent` for a large ``held`` and a batch read from disk.

    A small batch is broadcast and the held keys are streamed past it, so the
    table is not shuffled to find the few keys that matter. In a session with
    :func:`with_runtime_filters`, a larger batch becomes a Bloom filter on the scan of
    ``held``, so that few more than the keys that matter are shuffled.
    """
    # Spark builds such a filter only from a side with a comparison in its filter; all rows meet this one.
    asked = staged.where(F.xxhash64(*keys) >= F.lit(-(1 << 63)))
    known = held.select(*keys).join(asked.select(*keys), list(keys), "left_semi")
    return staged.join(known, list(keys), "left_anti")
