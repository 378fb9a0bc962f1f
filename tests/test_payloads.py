"""Payload parsing on awkward documents."""

import json

from pyspark.sql import functions as F

from tidemark.sources import payloads as P


def _docs(spark, *documents):
    texts = [d if d is None or isinstance(d, str) else json.dumps(d) for d in documents]
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def _tabular(spark, columns, *documents):
    rows = P.tabular_records(_docs(spark, *documents), columns).collect()
    return sorted([tuple(r) for r in rows], key=str)


def test_tabular_records(spark):
    doc = [["a", "b", "c"], ["1", "2", "3"], ["4", None, "6"]]
    assert _tabular(spark, ["c", "a", "b", "none"], doc) == [
        ("3", "1", "2", None),
        ("6", "4", None, None),
    ]


def test_the_longer_side_is_cut(spark):
    doc = [["a", "b"], ["1"], ["1", "2", "3"], []]
    assert _tabular(spark, ["a", "b"], doc) == [("1", "2"), ("1", None), (None, None)]


def test_last_of_repeated_names_counts(spark):
    doc = [["a", "a", "b", "a"], ["1", "2", "3", "4"], ["1", "2"], ["1"]]
    assert _tabular(spark, ["a", "b"], doc) == [("1", None), ("2", None), ("4", "3")]


def test_headers_may_differ_between_documents(spark):
    docs = [["a", "b"], ["1", "2"]], [["b", "a"], ["2", "1"]], [["a"]]
    assert _tabular(spark, ["a", "b"], *docs) == [("1", "2"), ("1", "2")]


def test_numbers_become_text(spark):
    assert _tabular(spark, ["a"], [["a"], [1], [2.5], [True]]) == [("1",), ("2.5",), ("true",)]


def test_rejects(spark):
    docs = _docs(spark, {"a": 1}, [], "nope", None, [["a"], ["1"]], [["a"]])
    got = {r.payload for r in P.tabular_rejects(docs).collect()}
    assert got == {'{"a": 1}', "[]", "nope", None}
    assert P.tabular_records(docs, ["a"]).count() == 1


def _nested(*series):
    return {"Results": {"series": list(series)}}


def test_all_points(spark):
    docs = _docs(
        spark,
        _nested(
            {"seriesID": "A", "data": [{"year": "2024", "value": "1"}, {"year": "2023"}]},
            {"seriesID": "B"},
            {"seriesID": "C", "data": []},
        ),
        _nested({"seriesID": "A", "data": [{"year": "2022", "value": 3}]}),
        {"Results": {}},
        {},
        "broken",
    )
    got = sorted(tuple(r) for r in P.all_points(docs).select("seriesID", "year").collect())
    assert got == [("A", "2022"), ("A", "2023"), ("A", "2024")]


def _point(year, **extra):
    return {"year": year, **extra}


def test_latest_points(spark):
    docs = _docs(
        spark,
        _nested(
            {"seriesID": "first flagged", "data": [
                _point("1"), _point("2", latest="true"), _point("3", latest="True")]},
            {"seriesID": "boolean", "data": [_point("1"), _point("2", latest=True)]},
            {"seriesID": "other words", "data": [_point("1"), _point("2", latest="TRUE")]},
            {"seriesID": "none", "data": [_point("1", latest="false"), _point("2")]},
            {"seriesID": "no data"},
            {"seriesID": "empty", "data": []},
            {"seriesID": "empty first", "data": [{}, _point("2")]},
        ),
    )
    got = {r.seriesID: r.year for r in P.latest_points(docs).collect()}
    assert got == {"first flagged": "2", "boolean": "2", "other words": "1", "none": "1"}
    assert P.choose_points(docs, latest_only=True).count() == 4
    assert P.choose_points(docs, latest_only=False).count() == 3 + 2 + 2 + 2 + 2


def test_latest_points_need_no_shuffle(spark):
    plan = P.latest_points(_docs(spark, _nested()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_read_payloads(spark, tmp_path):
    (tmp_path / "whole").mkdir()
    text = json.dumps([["a"], ["1"]], indent=1)
    (tmp_path / "whole" / "one.json").write_text(text)
    (tmp_path / "whole" / "two.json").write_text(text)
    whole = P.read_payloads(spark, str(tmp_path / "whole"))
    assert P.tabular_records(whole, ["a"]).count() == 2
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "many.txt").write_text('[["a"],["1"]]\n[["a"],["2"],["3"]]\n')
    lines = P.read_payloads(spark, str(tmp_path / "lines"), one_per_line=True)
    total = P.tabular_records(lines, ["a"]).agg(F.sum(F.col("a").cast("int"))).first()[0]
    assert total == 6
