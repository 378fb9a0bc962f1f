"""Upsert, insert-if-absent and contract gate."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import contracts as C
from tidemark.operators import gate, merge

KEYS = ("k",)
ORDER = ("ts", "v")
SCHEMA = "k int, ts int, v string"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _set(df):
    return {tuple(r) for r in df.collect()}


_row = st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 2)), st.sampled_from("ab"))
_table = st.lists(_row, max_size=6, unique_by=lambda r: r[0])


def _brute(base, delta, guard):
    def stamp(r):
        return (r[1] is not None, r[1] or 0, r[2])

    out = {r[0]: r for r in base}
    for r in delta:
        if not guard or r[0] not in out or stamp(r) >= stamp(out[r[0]]):
            out[r[0]] = r
    return set(out.values())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(base=_table, delta=_table, guard=st.booleans())
def test_upsert(spark, base, delta, guard):
    b, d = _frame(spark, base), _frame(spark, delta)
    order = ORDER if guard else ()
    want = _brute(base, delta, guard)
    once = merge.upsert(b, d, KEYS, order[:1], order[1:])
    assert _set(once) == want
    assert _set(merge.upsert(once, d, KEYS, order[:1], order[1:])) == want


def test_unguarded_lets_an_older_row_win(spark):
    base, delta = _frame(spark, [(1, 9, "new")]), _frame(spark, [(1, 1, "old")])
    assert _set(merge.upsert(base, delta, KEYS)) == {(1, 1, "old")}
    assert _set(merge.upsert(base, delta, KEYS, ("ts",), ("v",))) == {(1, 9, "new")}


def test_insert_if_absent(spark):
    held = _frame(spark, [(1, 1, "held")])
    delta = _frame(spark, [(1, 2, "late"), (2, 1, "new")])
    assert _set(merge.insert_if_absent(held, delta, KEYS)) == {(2, 1, "new")}
    assert _set(merge.insert_if_absent_staged(held, delta, KEYS)) == {(2, 1, "new")}


def test_reserved_names_are_refused(spark):
    frame = spark.createDataFrame([(1, 1)], f"k int, {merge.INCOMING} int")
    with pytest.raises(ValueError, match="reserved"):
        merge.upsert(frame, frame, KEYS)
    named = spark.createDataFrame([(1, 1)], "k int, incoming int")
    assert merge.upsert(named, named, KEYS).columns == ["k", "incoming"]


def _staged(spark, path, rows):
    df = spark.createDataFrame(rows, "k int, ts int, v string, part int")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_held_keys_are_not_shuffled_for_a_small_batch(spark, tmp_path):
    held = spark.range(100_000).select(F.col("id").cast("int").alias("k"))
    staged = _staged(spark, str(tmp_path / "s"), [(1, 2, "a", 0), (-1, 2, "a", 0)])
    new = merge.insert_if_absent_staged(held, staged, KEYS)
    assert "Exchange hashpartitioning" not in new._jdf.queryExecution().executedPlan().toString()
    assert [r.k for r in new.collect()] == [-1]


def test_gate(spark):
    contract = C.Contract("t", keys=("k",), required=("a", "b"))
    df = spark.createDataFrame(
        [(1, 1, 1), (2, None, None), (3, 1, None), (None, 1, 1)], "k int, a int, b int"
    )
    assert [r.k for r in gate.valid_rows(df, contract).collect()] == [1]
    rejected = {(r.k, r[gate.REASON]) for r in gate.rejected_rows(df, contract).collect()}
    assert rejected == {(2, "a"), (3, "b"), (None, "k")}


def test_fact_contract_rejects_null_key_parts(spark):
    assert set(C.FACT.not_null) == {
        "time", "dt", "year", "month", "category_code", "data_type_code",
        "time_slot_id", "is_seasonally_adjusted",
    }


def test_duplicate_keys(spark):
    df = _frame(spark, [(1, 1, "a"), (1, 2, "b"), (2, 1, "a"), (None, 1, "a"), (None, 2, "a")])
    assert _set(gate.duplicate_keys(df, KEYS)) == {(1, 2), (None, 2)}


def test_a_large_batch_becomes_a_bloom_filter(spark, tmp_path):
    """Above the broadcast threshold, few rows of the held table get past the scan."""
    session = merge.with_runtime_filters(spark, least="1", most="1g")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    keys = ("k", "t")
    for name, first, last in (("held", 0, 50_000), ("staged", 49_900, 50_100)):
        spark.range(first, last).selectExpr("cast(id as string) as k", "id as t", "id as v").write.parquet(
            str(tmp_path / name)
        )
    held, staged = (session.read.parquet(str(tmp_path / name)) for name in ("held", "staged"))
    rows = merge.insert_if_absent_staged(held, staged, keys)
    assert sorted(r.t for r in rows.collect()) == list(range(50_000, 50_100))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "might_contain" in plan and "bloom_filter_agg" in plan

    def shuffled(df):
        """Rows that each exchange of the executed plan wrote."""
        df.collect()
        found = []

        def walk(node):
            if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
                return walk(node.executedPlan())
            if "QueryStage" in node.getClass().getSimpleName():
                return walk(node.plan())
            if node.getClass().getSimpleName() == "ShuffleExchangeExec":
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            for i in range(children.size()):
                walk(children.apply(i))

        walk(df._jdf.queryExecution().executedPlan())
        return max(found)

    plain = spark.newSession()
    plain.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plain.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    unfiltered = merge.insert_if_absent_staged(
        *(plain.read.parquet(str(tmp_path / name)) for name in ("held", "staged")), keys
    )
    assert shuffled(unfiltered) == 50_000 and shuffled(rows) < 5_000
