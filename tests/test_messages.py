"""Message encoding, decoding and typing on awkward bodies."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidemark import contracts as C
from tidemark.functions import messages
from tidemark.sources import payloads as P

STAMP = "2024-05-01T10:00:00.123456+00:00"


def _points(spark, *data, series="S"):
    doc = {"Results": {"series": [{"seriesID": series, "data": list(data)}]}}
    frame = spark.createDataFrame([(json.dumps(doc),)], "payload string")
    return P.all_points(frame)


def _encoded(spark, *data, series="S"):
    rows = messages.encode_points(_points(spark, *data, series=series), F.lit(STAMP)).collect()
    return [(r.key, json.loads(r.value)) for r in rows]


def test_encode(spark):
    [(key, body)] = _encoded(
        spark,
        {"year": "2024", "period": "M01", "periodName": "January", "value": "1.5",
         "latest": "true", "footnotes": [{"code": "P", "text": "preliminary"}, {}, None]},
    )
    assert key == "S|2024|M01"
    assert body == {
        "ts_ingested": STAMP,
        "series_id": "S",
        "year": "2024",
        "period": "M01",
        "periodName": "January",
        "value": "1.5",
        "footnotes": ["preliminary"],
        "is_latest": True,
    }


def test_missing_parts_keep_their_place(spark):
    [(key, body)] = _encoded(spark, {"year": "2024"}, series=None)
    assert key == "None|2024|None"
    assert body["period"] is None and body["footnotes"] == [] and body["is_latest"] is False


def test_latest_flag_words(spark):
    words = ["true", "TRUE", True, "1", 1, "yes", "false", None]
    got = [b["is_latest"] for _, b in _encoded(spark, *[{"year": "1", "latest": w} for w in words])]
    assert got == [True, True, True, True, True, False, False, False]


def test_footnotes(spark):
    notes = [{}, None, {"code": "P"}, {"text": None}, {"text": "t", "code": "X"}]
    [(_, body)] = _encoded(spark, {"footnotes": notes})
    assert body["footnotes"] == [None, None, "t"]


def test_default_stamp_is_one_instant(spark):
    encoded = messages.encode_points(_points(spark, {"year": "1"}, {"year": "2"}))
    stamps = {json.loads(r.value)["ts_ingested"] for r in encoded.collect()}
    assert len(stamps) == 1
    stamp = dt.datetime.fromisoformat(stamps.pop())
    assert abs(stamp - dt.datetime.now(dt.timezone.utc)) < dt.timedelta(minutes=5)


def _decode(spark, *bodies):
    rows = [(b if b is None else bytearray(b, "utf-8"),) for b in bodies]
    return messages.decode_messages(spark.createDataFrame(rows, "value binary"))


def test_decode(spark):
    body = {"ts_ingested": STAMP, "series_id": "S", "year": "2024", "period": "M01",
            "periodName": "January", "value": "1.5", "footnotes": ["a"], "is_latest": True}
    df = _decode(spark, json.dumps(body))
    assert df.schema == C.STREAM_BRONZE_SCHEMA or [f.name for f in df.schema] == [
        f.name for f in C.STREAM_BRONZE_SCHEMA
    ]
    assert tuple(df.first()) == (STAMP, "S", 2024, "M01", "January", 1.5, ["a"], True)


def test_corrupt_bodies_are_kept_as_null_rows(spark):
    rows = _decode(spark, "{broken", None, "[]", "{}").collect()
    assert [tuple(r) for r in rows] == [(None,) * 7 + (False,)] * 4


def test_loose_fields(spark):
    rows = _decode(
        spark,
        json.dumps({"year": 2024, "value": "-", "is_latest": "Yes", "footnotes": "plain"}),
        json.dumps({"year": "x", "value": 2, "is_latest": "0"}),
        json.dumps({"is_latest": "maybe", "footnotes": [1, None]}),
    ).collect()
    assert [(r.year, r.value, r.is_latest) for r in rows] == [
        (2024, None, True),
        (None, 2.0, False),
        (None, None, False),
    ]
    assert rows[0].footnotes is None and rows[2].footnotes == ["1", None]


def test_type_points(spark):
    periods = ["M01", "M12", "M13", "Q01", "S01", "A01", "MXX", None]
    rows = [(STAMP, "S", 2024, p, "n", 1.0, ["a"], True) for p in periods]
    df = messages.type_points(spark.createDataFrame(rows, C.STREAM_BRONZE_SCHEMA))
    assert [f.name for f in df.schema] == [f.name for f in C.STREAM_SILVER_SCHEMA]
    assert [f.dataType for f in df.schema] == [f.dataType for f in C.STREAM_SILVER_SCHEMA]
    got = {r.period: (r.month, r.dt) for r in df.collect()}
    assert got["M01"] == (1, dt.date(2024, 1, 1))
    assert got["M12"] == (12, dt.date(2024, 12, 1))
    assert got["M13"] == (13, None)
    assert {got[p] for p in periods[3:]} == {(None, None)}


def test_type_points_accepts_the_all_text_schema(spark):
    rows = [(STAMP, "S", "2024", "M02", "n", "1.5", ["a"], "true"), (None, None, "x", None, None, "-", None, "q")]
    first, second = messages.type_points(spark.createDataFrame(rows, C.MESSAGE_SCHEMA)).collect()
    assert (first.year, first.value, first.is_latest, first.month) == (2024, 1.5, True, 2)
    assert tuple(second) == (None,) * 10
