"""How tables lie on disk, and the writers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import JSON_OPTIONS

Z = "_z"
#: Values looked at to choose split points of a column.
SAMPLE = 50_000


def partition_columns(df: DataFrame) -> list[str]:
    """Ingest date when the table carries it, else calendar month."""
    return ["ingest_date"] if "ingest_date" in df.columns else ["year", "month"]


def rebalance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring equal partition values together in evenly sized files.

    Unlike a plain repartition, adaptive execution splits a value that holds much
    of the table over many tasks and merges small ones.
    """
    return df.hint("rebalance", *columns)


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], replace_all: bool = True
) -> None:
    """Overwrite the table, or with ``replace_all=False`` only the partitions in ``df``."""
    (
        rebalance(df, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def split_points(df: DataFrame, column: str, cells: int, sample: int = SAMPLE) -> list:
    """At most ``cells`` - 1 values that part the rows evenly by ``column``, of any sortable type.

    From about ``sample`` rows, chosen by a hash of the value, so that an even share of
    the different values is looked at. They decide how well files are cut, nothing else.
    """
    values = df.select(F.col(f"`{column}`").alias("v")).where("v is not null")
    counted = values.groupBy("v").count()
    distinct = counted.count()
    chosen = F.pmod(F.xxhash64("v"), F.lit(max(1, distinct // sample))) == 0
    rows = counted.where(chosen).orderBy("v").collect()
    total, seen, points = sum(row["count"] for row in rows), 0, []
    for row in rows:
        if seen * cells >= total * (len(points) + 1):
            points.append(row.v)
        seen += row["count"]
    return points[: cells - 1]


def z_value(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of some numbers below 2 ** ``bits``, interleaved, highest first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            one = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1))
            to = len(ranks) * bit + len(ranks) - 1 - place
            out = out.bitwiseOR(F.shiftleft(one, to))
    return out


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 6
) -> None:
    """Write ``files`` files in Z-order of ``columns``, so that each holds a small box of all of them.

    A filter on any of the columns then skips most files and row groups by their
    statistics, where a sort helps its first column only. NULLs lie lowest.
    """

    def rank(column: str) -> Column:
        value, kind = F.col(f"`{column}`"), df.schema[column].dataType
        points = [F.lit(p).cast(kind) for p in split_points(df, column, 1 << bits)]
        held = F.array(*points).cast(T.ArrayType(kind))
        return F.when(value.isNull(), 0).otherwise(F.size(F.filter(held, lambda p: p <= value)))

    ranks = [rank(column) for column in columns]
    order = [Z, *columns]
    placed = df.withColumn(Z, z_value(ranks, bits)).repartitionByRange(files, *order)
    placed.sortWithinPartitions(*order).drop(Z).write.mode("overwrite").parquet(path)


def append_ingest(df: DataFrame, path: str, ingest_date: dt.date, replace_day: bool = False) -> None:
    """Add rows under ``ingest_date=<day>``.

    Appending twice on one day repeats rows, which later layers settle;
    ``replace_day`` makes a rerun replace the day instead.
    """
    writer = df.withColumn("ingest_date", F.lit(ingest_date)).write.partitionBy("ingest_date")
    if replace_day:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)


def write_jsonl(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.options(**JSON_OPTIONS).mode("overwrite")
    writer.partitionBy(*partition_by).json(path)


def database_columns(df: DataFrame) -> DataFrame:
    """Arrays as JSON text: not every database takes them over JDBC."""
    return df.select(
        *[
            F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def jdbc_properties(user: str, password: str, driver: str, page: int = 500) -> dict[str, str]:
    return {"user": user, "password": password, "driver": driver, "batchsize": str(page)}


def write_jdbc_staging(
    df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 8
) -> None:
    """Replace a database staging table from the executors.

    ``connections`` limits how many tasks write at once, since a database takes
    fewer writers than a cluster has tasks.
    """
    (
        database_columns(df)
        .write.mode("overwrite")
        .option("numPartitions", connections)
        .jdbc(url, table, properties=properties)
    )


def upsert_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """Statement that moves staged rows into a keyed database table; staged rows win."""
    names = ", ".join(columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {updates}"
    )


def insert_if_absent_statement(table: str, staging: str, columns: Sequence[str]) -> str:
    """Statement that moves staged rows into a keyed database table; held rows win."""
    names = ", ".join(columns)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON CONFLICT DO NOTHING"
