"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


RANK = "_rank"


def _total_order(recency: Sequence[str], tie: Sequence[str]) -> list[str]:
    if not recency or not tie:
        raise ValueError("recency and tie-breaking columns are both needed: ties are real")
    return [*recency, *(c for c in tie if c not in recency)]


def _newest_first(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], recency: Sequence[str], tie: Sequence[str]
) -> DataFrame:
    """One row per key: the newest by ``recency``, ties settled by ``tie``.

    NULLs sort as oldest and NULL keys form one group. Spark keeps only the first
    row of each key inside a map task before it shuffles, so a key that holds a
    third of the input sends at most one row per task.
    """
    if RANK in df.columns:
        raise ValueError(f"{RANK} is a reserved column name")
    order = _total_order(recency, tie)
    window = Window.partitionBy(*keys).orderBy(*_newest_first(order))
    ranked = df.withColumn(RANK, F.row_number().over(window))
    return ranked.where(F.col(RANK) == 1).drop(RANK)


def latest_by_aggregate(
    df: DataFrame, keys: Sequence[str], recency: Sequence[str], tie: Sequence[str]
) -> DataFrame:
    """The same rows as :func:`latest_per_key`, as an aggregate.

    This form also runs on a stream, where the state holds one row per key.
    """
    order = _total_order(recency, tie)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("row")).select(
        *[F.col(c) if c in keys else F.col(f"row.{c}") for c in df.columns]
    )


def as_of_latest(
    df: DataFrame, keys: Sequence[str], recency: Sequence[str], tie: Sequence[str]
) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY recency DESC``, which Spark lacks."""
    return latest_per_key(df, keys, recency, tie)


def drop_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key. Without ``order`` the survivor is only defined for full repeats."""
    if order is None:
        return df.dropDuplicates(list(keys))
    return latest_per_key(df, keys, order[:1], order[1:] or order)
