"""Keep-latest: ties, NULLs, both forms, and the plan under a hot key."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.latest import (
    as_of_latest,
    drop_repeats,
    latest_by_aggregate,
    latest_per_key,
)

SCHEMA = "k string, g int, ts int, tie int, v array<string>"


def _brute(rows):
    best = {}
    for k, g, ts, tie, v in rows:
        order = tuple((x is not None, x or 0) for x in (ts, tie))
        if (k, g) not in best or order > best[(k, g)][0]:
            best[(k, g)] = (order, (k, g, ts, tie, v))
    return {row for _, row in best.values()}


def _set(df):
    return {tuple(tuple(c) if isinstance(c, list) else c for c in r) for r in df.collect()}


@pytest.mark.parametrize("form", [latest_per_key, latest_by_aggregate, as_of_latest])
def test_ties_and_nulls(spark, form):
    rows = [
        ("a", 1, 5, 1, ("x",)),
        ("a", 1, 5, 2, ("y",)),
        ("a", 1, None, 9, ("z",)),
        ("a", None, 1, 1, ("n",)),
        ("a", None, 2, 1, ("m",)),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = form(df, ("k", "g"), ("ts",), ("tie",))
    assert out.columns == df.columns
    assert _set(out) == {rows[1], rows[4], rows[5]}


_small = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), _small, _small), max_size=25))
def test_both_forms_agree_with_brute_force(spark, rows):
    full = [(k, g, ts, i, ("v",)) for i, (k, g, ts) in enumerate(rows)]
    df = spark.createDataFrame(full, SCHEMA)
    want = _brute(full)
    assert _set(latest_per_key(df, ("k", "g"), ("ts",), ("tie",))) == want
    assert _set(latest_by_aggregate(df, ("k", "g"), ("ts",), ("tie",))) == want


@pytest.mark.parametrize("recency, tie", [(("ts",), ()), ((), ("tie",))])
def test_a_total_order_is_required(spark, recency, tie):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        latest_per_key(df, ("k",), recency, tie)
    with pytest.raises(ValueError):
        latest_by_aggregate(df, ("k",), recency, tie)


def test_drop_repeats(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    assert drop_repeats(df, ("k", "v")).count() == 3
    assert _set(drop_repeats(df, ("k",), ("v",))) == {("a", 1), ("b", 3)}


def test_a_hot_key_is_thinned_before_the_shuffle(spark):
    """A key with nearly all rows sends one row per map task."""
    df = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") < 190_000, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    out = latest_per_key(df, ("k",), ("id",), ("id",))
    before, after = out._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)
    assert "Final" in before and "Partial" in after
    assert out.count() == 10_001
    assert out.where("k = 0").first().id == 189_999
