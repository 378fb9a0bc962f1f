"""Fields beyond the declared schema."""

from pyspark.sql import types as T

from tidemark.functions import drift


def _rows(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "id int, body string")


def test_undeclared_fields_come_out_typed(spark):
    rows = _rows(
        spark,
        '{"known": "a", "n": 1, "o": {"p": [1, 2]}}',
        '{"n": 2.5, "odd name\'s": true, "mixed": 1}',
        '{"known": "b", "mixed": "x", "always": null}',
        "{broken", None, "[1]", '{"n": "text"}',
    )
    found = drift.with_undeclared(rows.where("id < 4"), "body", ["known"])
    kinds = dict(found.dtypes)
    assert kinds["extra_o"] == "struct<p:array<bigint>>" and kinds["extra_odd name\'s"] == "boolean"
    assert kinds["extra_mixed"] == kinds["extra_always"] == "string" and kinds["extra_n"].startswith("decimal")
    got = {r.id: r for r in found.collect()}
    assert float(got[0].extra_n) == 1 and float(got[1].extra_n) == 2.5 and got[0].extra_o.p == [1, 2]
    assert (got[1].extra_mixed, got[2].extra_mixed) == ("1", "x") and got[1]["extra_odd name\'s"] is True
    assert got[3].extra_n is None and got[3].extra_mixed is None
    assert "extra_known" not in found.columns


def test_nothing_undeclared(spark):
    for bodies in ((), (None,), ("{broken",), ("[1]", "3"), ('{"known": 1}',)):
        rows = _rows(spark, *bodies)
        assert drift.with_undeclared(rows, "body", ["known"]).columns == rows.columns
    assert drift.merged_schema(_rows(spark), "body") == T.StructType([])


def test_documents_that_disagree(spark):
    rows = _rows(spark, '{"a": 1}', "[1]", '{"a": {"b": 1}}')
    assert drift.merged_schema(rows, "body") == T.StructType([])
    some = drift.merged_schema(rows.where("id <> 1"), "body")
    assert drift.undeclared(some, [])[0].dataType == T.StringType()
