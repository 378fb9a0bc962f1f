"""Contract checks that set bad rows aside instead of failing the batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.contracts import Contract
from tidemark.operators.latest import latest_per_key

REASON = "reject_reason"
ALONE = "_alone"


def _any_null(columns: Sequence[str]) -> Column:
    """True when some column is NULL; never NULL itself, so it can be negated."""
    test = F.col(columns[0]).isNull()
    for name in columns[1:]:
        test = test | F.col(name).isNull()
    return test


def _reason(contract: Contract) -> Column:
    """The first offending column of a row, else NULL."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in contract.not_null])


def is_valid(contract: Contract) -> Column:
    return ~_any_null(contract.not_null)


def valid_rows(df: DataFrame, contract: Contract) -> DataFrame:
    return df.where(is_valid(contract))


def rejected_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows the contract turns away, with the first offending column as the reason."""
    return df.where(_any_null(contract.not_null)).withColumn(REASON, _reason(contract))


def newest_or_rejected(
    df: DataFrame,
    contract: Contract,
    keys: Sequence[str],
    recency: Sequence[str],
    tie: Sequence[str],
) -> DataFrame:
    """The rows that the contract turns away, and the newest per key of the others, in one pass.

    Each rejected row is a group of its own, so all of them come through the ranking.
    ``REASON`` is NULL for the rows that hold.
    """
    if ALONE in df.columns:
        raise ValueError(f"{ALONE} is a reserved column name")
    marked = df.withColumn(REASON, _reason(contract))
    alone = F.when(F.col(REASON).isNotNull(), F.monotonically_increasing_id())
    ranked = latest_per_key(marked.withColumn(ALONE, alone), [*keys, ALONE], recency, tie)
    return ranked.drop(ALONE)


def figures(seen: Observation) -> dict:
    """What was observed; nothing if the plan was found empty before it ran."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


@dataclass
class Measures:
    """What went by while a frame was written: rows, and rejected rows by reason."""

    rows: int
    rejects: dict[str, int]
    more: dict

    @property
    def valid(self) -> int:
        return self.rows - sum(self.rejects.values())


def measured(
    df: DataFrame, contract: Contract, **more: Column
) -> tuple[DataFrame, Callable[[], Measures]]:
    """``df``, and what it measured once an action on it has run; no scan of its own.

    ``more`` are further aggregates of the valid rows. The figures are for reports and
    for skipping what is empty: a map task that ran twice may count twice.
    """
    seen = Observation()
    reason = _reason(contract)
    counts = [F.count_if(reason == c).alias(f"{REASON}_{i}") for i, c in enumerate(contract.not_null)]
    others = [aggregate.alias(name) for name, aggregate in more.items()]
    observed = df.observe(seen, F.count("*").alias("rows"), *counts, *others)

    def result() -> Measures:
        found = figures(seen)
        rejects = {c: found.get(f"{REASON}_{i}") for i, c in enumerate(contract.not_null)}
        others = {name: found.get(name) for name in more}
        return Measures(found.get("rows", 0), {c: n for c, n in rejects.items() if n}, others)

    return observed, result


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; counts are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
