"""A keyed table on disk: a base, and the steps published after it.

A step is written to a hidden folder and published by one rename that overwrites
nothing: readers see all of it or none, and a writer that dies leaves nothing that
counts. Its path tells its number and which step of which run it is, so a repeated
step is recognised. Readers rank the base and the steps after it. ``fold`` makes
them a new base, published the same way, so it may run beside writers; ``expire``
deletes what a base has taken up.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.gate import REASON
from tidemark.operators.latest import latest_per_key
from tidemark.operators.layout import rebalance
from tidemark.workspace import delete, exists, folders, hidden, publish, read_text, settle_text

STAMP, RUN, STEP, KIND = "_stamp", "_run", "_step", "_kind"
CHANGES, REJECTS, SKETCHES = "changes", "rejects", "sketches"
FOLD_EVERY = 64


def number_of(path: str, name: str = STAMP) -> int:
    """The number that a path names."""
    return int(re.search(rf"{name}=(\d+)", path).group(1))


def stamps(spark: SparkSession, root: str) -> list[int]:
    return sorted(number_of(path) for path in folders(spark, f"{root}/steps/{STAMP}=*"))


def base_of(spark: SparkSession, root: str) -> int:
    """The last step that a base has taken up, else 0."""
    return max([0, *(number_of(path, "upto") for path in folders(spark, f"{root}/base/upto=*"))])


def is_published(spark: SparkSession, root: str, run: str, step: int) -> bool:
    return bool(folders(spark, f"{root}/steps/{STAMP}=*/{RUN}={quote(run, '')}/{STEP}={step}"))


def prepare(root: str, run: str | None, step: int) -> tuple[str, str]:
    """A hidden folder, and the place in it where this step's kinds of rows go."""
    made = hidden(root)
    return made, f"{made}/{RUN}={quote(run or uuid.uuid4().hex, '')}/{STEP}={step}"


def publish_step(spark: SparkSession, root: str, made: str) -> int:
    """Give a prepared step the next number. The newest step is never deleted, so numbers grow."""
    while True:
        stamp = max([base_of(spark, root), *stamps(spark, root)]) + 1
        if publish(spark, made, f"{root}/steps/{STAMP}={stamp}"):
            return stamp


def order_of(spark: SparkSession, root: str) -> list[str]:
    path = f"{root}/order.json"
    return json.loads(read_text(spark, path)) if exists(spark, path) else []


def settle_order(spark: SparkSession, root: str, order: Sequence[str]) -> None:
    """Fix what makes a row of the table newer; another order is refused."""
    held = json.loads(settle_text(spark, f"{root}/order.json", json.dumps(list(order))))
    if held != list(order):
        raise ValueError(f"the table is ordered by {held}, not by {list(order)}")


def append(
    spark: SparkSession,
    root: str,
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    run: str | None = None,
    step: int = 0,
    fold_every: int = FOLD_EVERY,
    partition_by: Sequence[str] = (),
) -> None:
    """Put ``rows``, one per key, into the table; a step of a run is put in once.

    With ``order`` the row that is newest by it wins, else the incoming one.
    """
    settle_order(spark, root, order)
    if run is not None and is_published(spark, root, run, step):
        return
    made, inside = prepare(root, run, step)
    rows.write.parquet(f"{inside}/{KIND}={CHANGES}")
    stamp = publish_step(spark, root, made)
    fold_if_due(spark, root, keys, stamp, fold_every, partition_by)


def read_kind(
    spark: SparkSession, root: str, kind: str, after: int = 0
) -> DataFrame | None:
    """Rows of one kind of the steps after a number, with the step's number."""
    found = folders(spark, f"{root}/steps/{STAMP}=*/{RUN}=*/{STEP}=*/{KIND}={kind}")
    found = [path for path in found if number_of(path) > after]
    if not found:
        return None
    rows = spark.read.option("basePath", f"{root}/steps").parquet(*found)
    return rows.drop(RUN, STEP, KIND)


def read(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame | None:
    """The table, else None. Without steps after the base, nothing is ranked."""
    base = base_of(spark, root)
    rows = spark.read.parquet(f"{root}/base/upto={base}") if base else None
    changes = read_kind(spark, root, CHANGES, after=base)
    if changes is None:
        return rows
    changes = changes.drop(REASON)
    if rows is not None:
        changes = changes.unionByName(rows.withColumn(STAMP, F.lit(base)))
    order = [*order_of(spark, root), STAMP]
    return latest_per_key(changes, keys, order, order).drop(STAMP)


def read_kept(spark: SparkSession, root: str, kind: str) -> DataFrame | None:
    """Rows of a kind that outlives its steps, with the step's number."""
    old = None
    if folders(spark, f"{root}/{kind}/{STAMP}=*"):
        old = spark.read.parquet(f"{root}/{kind}")
    new = read_kind(spark, root, kind)
    return new if old is None else old if new is None else old.unionByName(new)


def read_rejects(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows that the steps turned away."""
    return read_kept(spark, root, REJECTS)


def fold_if_due(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    stamp: int,
    fold_every: int,
    partition_by: Sequence[str] = (),
) -> None:
    if fold_every and stamp % fold_every == 0:
        fold(spark, root, keys, partition_by)


def fold(
    spark: SparkSession, root: str, keys: Sequence[str], partition_by: Sequence[str] = ()
) -> None:
    """Rewrite the table as a new base. Steps published meanwhile simply come after it."""
    upto = max([0, *stamps(spark, root)])
    if upto <= base_of(spark, root):
        return
    rows, made = read(spark, root, keys), hidden(root)
    if rows is None:
        return
    if partition_by:
        rows = rebalance(rows, partition_by)
    rows.write.partitionBy(*partition_by).parquet(made)
    if not publish(spark, made, f"{root}/base/upto={upto}"):
        delete(spark, made)


def expire(
    spark: SparkSession, root: str, keep: int = 1, needed: Callable[[int], bool] | None = None
) -> list[str]:
    """Delete bases but the newest ``keep``, and steps that the oldest of these has taken up.

    Rejected rows and sketches stay. Steps that are ``needed`` for something else stay, and so does the
    newest. Frames that were planned over deleted files stop working.
    """
    if keep < 1:
        raise ValueError("at least one base must be kept")
    bases = sorted(folders(spark, f"{root}/base/upto=*"), key=lambda path: number_of(path, "upto"))
    stale = bases[:-keep]
    upto = number_of(bases[-keep:][0], "upto") if bases else 0
    for stamp in stamps(spark, root)[:-1]:
        if stamp <= upto and not (needed and needed(stamp)):
            stale.append(f"{root}/steps/{STAMP}={stamp}")
            for kind in (REJECTS, SKETCHES):
                for kept in folders(spark, f"{stale[-1]}/{RUN}=*/{STEP}=*/{KIND}={kind}"):
                    publish(spark, kept, f"{root}/{kind}/{STAMP}={stamp}")
    for path in stale:
        delete(spark, path)
    return stale
