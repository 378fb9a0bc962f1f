"""Clustered files: the same rows, and fewer row groups for a filter on either column."""

import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidemark.operators import layout


def _groups(path, column, value):
    """Row groups whose statistics let ``value`` pass, and all row groups."""
    passing = total = 0
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(f"{path}/{name}").metadata
            at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
            for group in range(meta.num_row_groups):
                stats = meta.row_group(group).column(at).statistics
                total += 1
                passing += stats is None or stats.min <= value <= stats.max
    return passing, total


def test_filters_on_either_column_skip_most_row_groups(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.expr("date_add(date'2000-01-01', cast(pmod(xxhash64(id), 1000) as int))").alias("dt"),
        F.format_string("%03d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(200))).alias("code"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("source"),
        "id",
    ).withColumn("a.b", F.lit(1))
    path, by_sort = str(tmp_path / "z"), str(tmp_path / "s")
    layout.write_clustered(rows, path, ["dt", "code"], 64)
    rows.repartitionByRange(64, "dt", "code").sortWithinPartitions("dt", "code").write.parquet(by_sort)
    held = spark.read.parquet(path)
    assert held.columns == rows.columns and held.exceptAll(rows).isEmpty() and held.count() == 20_000
    day = held.select(F.max("dt")).first()[0]
    for column, value in (("dt", day.replace(year=2001)), ("code", "117")):
        passing, total = _groups(path, column, value)
        assert total >= 60 and passing <= 0.35 * total, (column, passing, total)
    assert _groups(by_sort, "code", "117")[0] > 55
    assert held.where("code = '117'").count() == rows.where("code = '117'").count()


def test_columns_with_nulls_ties_and_one_value(spark, tmp_path):
    rows = spark.createDataFrame(
        [(None, "x")] * 5 + [(1, "x")] * 50 + [(2, None), (3, "x")], "a int, b string"
    )
    path = str(tmp_path / "z")
    layout.write_clustered(rows, path, ["a", "b"], 4)
    assert sorted(spark.read.parquet(path).collect(), key=str) == sorted(rows.collect(), key=str)
    layout.write_clustered(rows.limit(0), path, ["a", "b"], 4)
    assert spark.read.parquet(path).count() == 0
    assert layout.split_points(rows, "b", 8) == [] and set(layout.split_points(rows, "a", 8)) <= {1, 2, 3}


def test_bits_are_interleaved(spark):
    rows = spark.range(64).selectExpr("id div 8 as x", "id % 8 as y")
    for row in rows.select("x", "y", layout.z_value([F.col("x"), F.col("y")], 3).alias("z")).collect():
        want = int("".join(a + b for a, b in zip(f"{row.x:03b}", f"{row.y:03b}")), 2)
        assert row.z == want
