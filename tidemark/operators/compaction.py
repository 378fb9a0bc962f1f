"""Append-only rows: many small folders rewritten to few files, and swapped by one rename.

Rows lie in loose folders, numbered as they came, and in packed folders that each
took up a span of numbers. A packed folder counts as soon as it is renamed into its
place, and from then on everything inside its span does not: readers go by the names
alone. So nothing is ranked or compared, and readers, writers and a packer that dies
half way do not disturb each other. ``expired`` tells what may be deleted.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.workspace import delete, publish, size_of

#: Bytes of a packed file; a packed folder of less than half is packed again.
TARGET = 128 << 20
_SPAN = re.compile(r"_span=(\d+)-(\d+)")


@dataclass(frozen=True)
class Packed:
    first: int
    last: int
    path: str

    @classmethod
    def at(cls, path: str) -> Packed:
        first, last = map(int, _SPAN.search(path).groups())
        return cls(first, last, path)

    def holds(self, other: Packed) -> bool:
        return self != other and self.first <= other.first and other.last <= self.last


@dataclass
class Place:
    """The folders of one part of a table, such as a day: packed ones, loose ones by number."""

    packed: list[Packed] = field(default_factory=list)
    loose: dict[int, str] = field(default_factory=dict)

    def live(self) -> list[Packed]:
        """Packed folders that no wider one has taken up, in order."""
        spans = [p for p in self.packed if not any(q.holds(p) for q in self.packed)]
        return sorted(spans, key=lambda p: p.first)

    def upto(self) -> int:
        """The last number that is packed, or -1."""
        return max((p.last for p in self.packed), default=-1)

    def open(self) -> dict[int, str]:
        return {n: path for n, path in sorted(self.loose.items()) if n > self.upto()}

    def paths(self) -> list[str]:
        """The folders that hold each row once."""
        return [*(p.path for p in self.live()), *self.open().values()]

    def expired(self) -> list[str]:
        live, open_ = self.live(), self.open()
        stale = [p.path for p in self.packed if p not in live]
        return stale + [path for n, path in self.loose.items() if n not in open_]


def read_paths(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, number: str, named: str
) -> DataFrame:
    """Rows of the folders with the ``number`` each came under.

    Packed files hold it as a column; of others the path tells it, behind ``named``.
    """
    declared = T.StructType([*schema.fields, T.StructField(number, T.IntegerType())])
    told = F.regexp_extract(F.col("_metadata.file_path"), rf"{named}=(\d+)", 1)
    rows = spark.read.schema(declared).parquet(*paths)
    return rows.withColumn(number, F.coalesce(number, told.try_cast("int")))


def packing(spark: SparkSession, target: int) -> SparkSession:
    """A session whose scans put whole small files together up to ``target`` bytes a task."""
    session = spark.newSession()
    settings = {
        "spark.sql.files.maxPartitionBytes": target,
        "spark.sql.files.openCostInBytes": 0,
        "spark.sql.files.minPartitionNum": 1,
    }
    for name, value in settings.items():
        session.conf.set(name, str(value))
    return session


def plan(
    spark: SparkSession, place: Place, newest: int, target: int
) -> tuple[int, int, list[str]] | None:
    """First and last number and the folders to pack now: the open ones and small ones before."""
    live, open_ = place.live(), place.open()
    tail: list[Packed] = []
    while live and size_of(spark, live[-1].path) < target // 2:
        tail.insert(0, live.pop())
    if not open_ and len(tail) < 2:
        return None
    first = tail[0].first if tail else live[-1].last + 1 if live else 0
    last = newest if open_ else tail[-1].last
    return first, last, [*(p.path for p in tail), *open_.values()]


def pack(
    spark: SparkSession,
    place: Place,
    newest: int,
    root: str,
    made: str,
    schema: T.StructType,
    number: str,
    named: str,
    target: int = TARGET,
) -> str | None:
    """Rewrite what is due of a place to files of about ``target`` bytes, and publish it in ``root``.

    ``newest`` is the newest number that any place had when this one was listed. There
    is no shuffle: each task reads whole small files and writes one.
    """
    due = plan(spark, place, newest, target)
    if due is None:
        return None
    first, last, paths = due
    rows = read_paths(packing(spark, target), paths, schema, number, named)
    rows.write.parquet(made)
    final = f"{root}/_span={first}-{last}"
    if publish(spark, made, final):
        return final
    delete(spark, made)
    return None
