"""Every query against its SQL counterpart, whole tables, order does not matter."""

import math
import os

import duckdb
import pytest

from tidemark.plans import catalog, oracles

SF_DIR = os.environ.get("TIDEMARK_TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = catalog.QUERIES
ORACLES = oracles.ORACLES


# A global aggregate brings one partial row per task together; nothing else may.
ONE_ROW_AGGREGATES = {
    (name, "SinglePartition") for name in ("dim_date", "gold_counts", "sketched_counts")
}


PARSED_ONCE = ("latest_view", "database_staging_rows", "decode_messages", "tabular_payload_records")


@pytest.mark.parametrize("name", PARSED_ONCE)
def test_documents_are_parsed_once(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_flagged_points_are_looked_for_once(spark):
    rows = QUERIES["payload_latest_point"](spark, SF_DIR)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("IN (true,True)") + plan.count("INSET") == 1


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        db.execute(f"create view {table} as select * from read_parquet('{SF_DIR}/{name}')")
    yield db
    db.close()


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "SinglePartition"):
        assert word not in plan or (name, word) in ONE_ROW_AGGREGATES
    want = _rows(columns, expected.fetchall())
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    assert len(got) == len(want)
    assert got == want
    assert got, "a query over the given tables must return rows"
