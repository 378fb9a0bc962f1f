"""The jobs as a user starts them."""

import datetime as dt
import json

import pytest

from tidemark import contracts as C
from tidemark.__main__ import main, parser
from tidemark.streaming import gold, silver


def test_batch_jobs(spark, tmp_path):
    def folder(name):
        return str(tmp_path / name)

    (tmp_path / "in").mkdir()
    rows = [["SM", "0", "no", "44X", v, "no", t] for v, t in (("1", "2022-12"), ("1,000", "2024-01"))]
    (tmp_path / "in" / "a.json").write_text(json.dumps([list(C.FACT_RAW_COLUMNS), *rows]))
    (tmp_path / "in" / "b.json").write_text("{}")
    main(["land", "--payloads", folder("in"), "--raw", folder("raw"), "--bronze", folder("b"),
          "--since", "2023", "--ingest-date", "2024-03-01", "--rejects", folder("r")])
    main(["silver", "--bronze", folder("b"), "--silver", folder("s"), "--since", "2024-03-01"])
    for _ in range(2):
        main(["gold", "--silver", folder("s"), "--gold", folder("g")])
    main(["compact", "--gold", folder("g")])
    main(["expire", "--gold", folder("g")])
    main(["serve", "--gold", folder("g"), "--out", folder("o")])
    assert spark.read.parquet(folder("o") + "/series_monthly").count() == 1
    assert [r.value for r in spark.read.text(folder("r")).collect()] == ["{}"]
    [row] = spark.read.parquet(folder("o") + "/fact_latest").collect()
    assert (row.dt, row.value, row.ingest_date) == (dt.date(2024, 1, 1), 1000.0, dt.date(2024, 3, 1))
    assert spark.read.parquet(folder("o") + "/dim_date").count() == 1


def test_stream_jobs(spark, tmp_path):
    def folder(name):
        return str(tmp_path / name)

    row = ("2024-01-01T10:00:00+00:00", "A", 2024, "M01", "n", 1.0, None, True)
    spark.createDataFrame([row], C.STREAM_BRONZE_SCHEMA).write.parquet(folder("b"))
    main(["stream-silver", "--bronze", folder("b"), "--silver", folder("s"),
          "--checkpoint", folder("cs"), "--drain", "--max-files", "1"])
    main(["stream-gold", "--silver", folder("s"), "--gold", folder("g"),
          "--checkpoint", folder("cg"), "--drain"])
    assert gold.read_history(spark, folder("g")).count() == 1
    for job in ("compact", "expire"):
        main([job, "--stream-gold", folder("g"), "--silver", folder("s"), "--keep-epochs", "0"])
    main(["compact", "--stream-gold", folder("g"), "--before", "2025-01-01"])
    assert gold.read_latest(spark, folder("g")).count() == 1
    assert gold.read_history(spark, folder("g")).count() == 1
    assert silver.read_silver(spark, folder("s")).count() == 1


def test_defaults():
    a = parser().parse_args(["stream-bronze", "--bronze", "b", "--checkpoint", "c", "--topic", "t"])
    assert (a.trigger_seconds, a.max_seconds, a.start) == (10, 60, "latest")
    a = parser().parse_args(["stream-gold", "--silver", "s", "--gold", "g", "--checkpoint", "c"])
    assert (a.trigger_seconds, a.max_seconds, a.incoming_wins) == (5, 90, False)
    with pytest.raises(SystemExit):
        parser().parse_args(["unknown"])
