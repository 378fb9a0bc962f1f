"""Streaming layers: equivalence with batch, epochs, replay, restart, late rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark import contracts as C
from tidemark.functions import messages
from tidemark.operators import keyed
from tidemark.sources.streams import read_files
from tidemark.streaming import bronze, gold, runs, silver
from tidemark.workspace import ensure_folder


def _iso(minute):
    return f"2024-01-01T10:{minute:02d}:00+00:00"


def _land(spark, path, *rows):
    """(minute, series, period, value) rows as one bronze file."""
    full = [
        (None if m is None else _iso(m), s, 2024, p, "n", v, ["note"], False) for m, s, p, v in rows
    ]
    spark.createDataFrame(full, C.STREAM_BRONZE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


class Pipe:
    def __init__(self, spark, root, **gold_options):
        self.spark, self.root, self.gold_options = spark, str(root), gold_options
        self.bronze, self.silver, self.gold = (f"{self.root}/{n}" for n in ("b", "s", "g"))
        self.checkpoint = f"{self.root}/cg"

    def run(self, *rows):
        if rows:
            _land(self.spark, self.bronze, *rows)
        runs.wait(silver.stream_silver(self.spark, self.bronze, self.silver, f"{self.root}/cs"))
        runs.wait(
            gold.stream_gold(
                self.spark, self.silver, self.gold, self.checkpoint, **self.gold_options
            )
        )

    def latest(self):
        table = gold.read_latest(self.spark, self.gold)
        return {r.series_id: (r.ts_ingested.minute, r.value) for r in table.collect()}

    def history(self):
        rows = gold.read_history(self.spark, self.gold).collect()
        return sorted((r.series_id, r.ts_ingested.minute, r.value, r.version) for r in rows)

    def silver_rows(self):
        rows = self.spark.read.parquet(self.silver).collect()
        return sorted((r.batch_id, r.series_id, r.period, r.value) for r in rows)


def test_silver_is_latest_within_a_batch_only(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    pipe.run((1, "A", "M01", 1.0), (2, "A", "M01", 2.0), (1, "A", "M02", 3.0), (1, "B", "Q01", 4.0))
    pipe.run((0, "A", "M01", 9.0))
    assert pipe.silver_rows() == [
        (0, "A", "M01", 2.0), (0, "A", "M02", 3.0), (0, "B", "Q01", 4.0), (1, "A", "M01", 9.0),
    ]


def test_gold_history_and_latest(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    pipe.run((1, "A", "M01", 1.0), (5, "A", "M02", 2.0), (3, "B", "M01", 3.0), (9, "C", "M13", 4.0))
    assert pipe.latest() == {"A": (5, 2.0), "B": (3, 3.0)}
    assert pipe.history() == [("A", 5, 2.0, 1), ("B", 3, 3.0, 1)]
    # A late older row for A, a newer one for B, a held instant of A again, a new series.
    pipe.run((2, "A", "M03", 5.0), (7, "B", "M02", 6.0), (1, "D", "M01", 7.0))
    assert pipe.latest() == {"A": (5, 2.0), "B": (7, 6.0), "D": (1, 7.0)}
    pipe.run((5, "A", "M04", 8.0))
    assert [h for h in pipe.history() if h[0] == "A"] == [("A", 2, 5.0, 2), ("A", 5, 2.0, 1)]
    rejects = keyed.read_rejects(spark, pipe.gold).collect()
    assert [(r.series_id, r.reject_reason, r[keyed.STAMP]) for r in rejects] == [("C", "dt", 1)]


def test_unguarded_latest_takes_the_late_row(spark, tmp_path):
    pipe = Pipe(spark, tmp_path, guard_recency=False)
    pipe.run((5, "A", "M01", 1.0), (1, "B", "M01", 1.0))
    pipe.run((2, "A", "M01", 2.0))
    assert pipe.latest() == {"A": (2, 2.0), "B": (1, 1.0)}


def test_restart_adds_nothing(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    pipe.run((1, "A", "M01", 1.0), (1, "B", "M01", 2.0))
    before = pipe.silver_rows(), pipe.latest(), pipe.history()
    pipe.run()
    assert (pipe.silver_rows(), pipe.latest(), pipe.history()) == before


def test_replayed_epochs_change_nothing(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    pipe.run((1, "A", "M01", 1.0), (1, "B", "M01", 2.0))
    pipe.run((2, "A", "M01", 3.0), (1, "B", "M01", 9.0))
    before = pipe.latest(), pipe.history()
    reader = gold.read_latest(spark, pipe.gold)
    batch = spark.read.parquet(f"{pipe.silver}").where("batch_id = 1")
    run = gold.run_of(spark, pipe.checkpoint)
    for _ in range(2):
        gold.write_gold_batch(batch, 1, pipe.gold, run=run)
    assert (pipe.latest(), pipe.history()) == before
    assert reader.count() == 2  # its files are still there


def test_a_cleared_checkpoint_loses_and_hides_nothing(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    for minute in range(3):
        pipe.run((minute, "A", "M01", float(minute)), (minute, "B", "M01", float(minute)))
    held = pipe.history()
    pipe.checkpoint = f"{pipe.root}/fresh"
    pipe.run((9, "A", "M01", 99.0), (9, "C", "M01", 1.0))
    assert pipe.latest() == {"A": (9, 99.0), "B": (2, 2.0), "C": (9, 1.0)}
    after = pipe.history()
    assert set(held) <= set(after)
    assert [h[:2] for h in after if h not in held] == [("A", 9), ("C", 9)]
    assert len({h[:2] for h in after}) == len(after)


def test_a_cleared_silver_checkpoint_keeps_written_files(spark, tmp_path):
    source, out = str(tmp_path / "b"), str(tmp_path / "s")
    for checkpoint in ("c1", "c2"):
        _land(spark, source, (1, "A", "M01", 1.0))
        runs.wait(silver.stream_silver(spark, source, out, str(tmp_path / checkpoint)))
        first = set(spark.read.parquet(out).inputFiles()) if checkpoint == "c1" else first
    assert first < set(spark.read.parquet(out).inputFiles())


def test_a_failed_epoch_is_not_published(spark, tmp_path, monkeypatch):
    pipe = Pipe(spark, tmp_path)
    pipe.run((1, "A", "M01", 1.0))
    before = pipe.latest(), pipe.history()
    real = keyed.publish_step

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(keyed, "publish_step", fail)
    with pytest.raises(Exception, match="lost"):
        pipe.run((2, "A", "M01", 2.0))
    assert (pipe.latest(), pipe.history()) == before
    monkeypatch.setattr(keyed, "publish_step", real)
    pipe.run()
    assert pipe.latest() == {"A": (2, 2.0)}
    assert [h[:3] for h in pipe.history()] == [("A", 1, 1.0), ("A", 2, 2.0)]


def test_folded_and_expired_tables_read_the_same(spark, tmp_path):
    pipe = Pipe(spark, tmp_path, fold_every=2)
    for minute in range(5):
        pipe.run((minute, "A", "M01", float(minute)), (4 - minute, "B", "M01", float(minute)))
    want = {"A": (4, 4.0), "B": (4, 0.0)}
    assert pipe.latest() == want
    gold.fold_latest(spark, pipe.gold)
    assert pipe.latest() == want
    assert len(gold.compact_history(spark, pipe.gold, dt.date(2025, 1, 1))) == 1
    assert pipe.latest() == want and len(pipe.history()) == 10
    assert gold.expire_gold(spark, pipe.gold)
    assert pipe.latest() == want and len(pipe.history()) == 10
    pipe.run((9, "A", "M01", 9.0))
    assert pipe.latest() == {"A": (9, 9.0), "B": (4, 0.0)}
    pipe.run((9, "A", "M01", 7.0))  # held, though its step is packed
    assert len(pipe.history()) == 11


def _instants(*days):
    return [
        (dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc), f"S{d}-{i}", 2024, "M01", "n", 1.0, None, True, 1, dt.date(2024, 1, 1))
        for i, d in enumerate(days)
    ]


def _batch(spark, *days):
    return spark.createDataFrame(_instants(*days), C.STREAM_SILVER_SCHEMA)


def _files(root):
    return [f for _, _, names in os.walk(root) for f in names if f.endswith(".parquet")]


def test_packed_days_read_the_same_in_few_files(spark, tmp_path):
    root = str(tmp_path / "g")
    days = [(1,), (1, 2), (2, 3), (3, 1), (4,), (4, 2)]
    for epoch, chosen in enumerate(days):
        gold.write_gold_batch(_batch(spark, *chosen), epoch, root, run="r", fold_every=0)

    def history(**window):
        rows = gold.read_history(spark, root, **window).collect()
        return sorted((r.series_id, r.ts_ingested.day, r.version) for r in rows)

    before = history()
    made = gold.compact_history(spark, root)
    assert [path.split("=")[1].split("/")[0] for path in made] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert history() == before and not gold.compact_history(spark, root)
    assert len(_files(f"{root}/history")) <= 2 * 3  # one scan may end in two tasks
    window = dict(first=dt.date(2024, 1, 2), last=dt.date(2024, 1, 3))
    assert history(**window) == [h for h in before if h[1] in (2, 3)]
    assert gold.expire_gold(spark, root) == []  # the latest table has no base yet
    gold.fold_latest(spark, root)
    assert gold.expire_gold(spark, root) and history() == before
    # A late row of a packed day, then all days packed again: what was taken up goes.
    gold.write_gold_batch(_batch(spark, 5, 5, 1), 6, root, run="r", fold_every=0)
    late = history()
    assert len(late) == len(before) + 3
    gold.compact_history(spark, root, before=dt.date(2025, 1, 1))
    assert history() == late
    gold.fold_latest(spark, root)
    gold.expire_gold(spark, root)
    assert history() == late and gold.read_latest(spark, root).count() == len({h[0] for h in late})
    spans = [n for _, names, _ in os.walk(f"{root}/history") for n in names if n.startswith("_span")]
    assert len(spans) == 5


def test_days_with_full_files_are_not_rewritten(spark, tmp_path):
    root = str(tmp_path / "g")
    for epoch, chosen in enumerate([(1, 1, 1), (2,), (1,), (3,), (1,), (4,)]):
        own = F.concat("series_id", F.lit(f"-{epoch}"))
        rows = _batch(spark, *chosen).withColumn("series_id", own)
        gold.write_gold_batch(rows, epoch, root, run="r", fold_every=0)
        made = gold.compact_history(spark, root, target=4_000)  # every packed file is large enough
        assert all("ingest_day=2024-01-01" in path or epoch for path in made)
    first = [p for p in os.listdir(f"{root}/history/ingest_day=2024-01-01") if p.startswith("_span")]
    assert len(first) == 3
    assert gold.read_history(spark, root).count() == 8


def test_a_packer_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    from tidemark.operators import compaction

    root = str(tmp_path / "g")
    for epoch in range(3):
        gold.write_gold_batch(_batch(spark, 1, 2), epoch, root, run="r", fold_every=0)
    before = sorted(gold.read_history(spark, root).collect())

    def die(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(compaction, "publish", die)
        with pytest.raises(RuntimeError):
            gold.compact_history(spark, root)
    assert sorted(gold.read_history(spark, root).collect()) == before
    assert gold.compact_history(spark, root) and sorted(gold.read_history(spark, root).collect()) == before


def test_packed_silver_reads_the_same_and_is_not_streamed_again(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    for minute in range(4):
        pipe.run((minute, "A", "M01", float(minute)), (minute, "B", "M02", 1.0))

    def rows():
        return sorted((r.batch_id, r.series_id, r.value) for r in silver.read_silver(spark, pipe.silver).collect())

    before, served = rows(), (pipe.latest(), pipe.history())
    assert len(silver.compact_silver(spark, pipe.silver, keep=2)) == 1 and rows() == before
    assert not silver.compact_silver(spark, pipe.silver, keep=2)
    assert len(silver.expire_silver(spark, pipe.silver)) == 2 and rows() == before
    pipe.run()
    assert (pipe.latest(), pipe.history()) == served
    pipe.run((9, "A", "M01", 9.0))
    silver.compact_silver(spark, pipe.silver)
    silver.expire_silver(spark, pipe.silver)
    assert rows() == [*before, (4, "A", 9.0)] and pipe.latest()["A"] == (9, 9.0)


def test_read_files_are_archived(spark, tmp_path):
    source, archive = str(tmp_path / "in"), str(tmp_path / "old")

    def run():
        runs.wait(silver.stream_silver(
            spark, source, str(tmp_path / "s"), str(tmp_path / "c"), max_files=1, archive=archive
        ))
        return len([f for f in os.listdir(source) if f.endswith(".parquet")])

    for minute in range(3):
        _land(spark, source, (minute, "A", "M01", float(minute)))
    assert run() == 1 and len(_files(archive)) == 2
    _land(spark, source, (7, "A", "M01", 7.0))
    assert run() == 1 and len(_files(archive)) == 3
    assert silver.read_silver(spark, str(tmp_path / "s")).count() == 4


def test_an_epoch_reads_its_batch_once_and_measures_it(spark, tmp_path):
    seen = {}
    pipe = Pipe(spark, tmp_path, on_measures=lambda measures, epoch: seen.update({epoch: measures}))
    pipe.run((1, "A", "M01", 1.0), (2, "A", "M02", 2.0), (1, "B", "Q01", 1.0), (None, "C", "M01", 1.0))
    pipe.run((3, "C", "Q01", 1.0))
    pipe.run()
    assert {e: (m.rows, m.valid, m.rejects) for e, m in seen.items()} == {
        0: (4, 2, {"dt": 1, "ts_ingested": 1}), 1: (1, 0, {"dt": 1}),
    }
    reads = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def count(value):
        reads.add(1)
        return value

    batch = _batch(spark, 1, 1, 2).withColumn("value", count("value"))
    found = gold.write_gold_batch(batch, 0, str(tmp_path / "once"))
    assert (found.rows, reads.value) == (3, 3)
    assert gold.write_gold_batch(_batch(spark), 1, str(tmp_path / "once")).rows == 0
    assert keyed.stamps(spark, str(tmp_path / "once")) == [1]


def test_a_batch_of_rejects_commits_nothing(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    pipe.run((1, "A", "Q01", 1.0), (None, "B", "M01", 1.0))
    assert gold.read_latest(spark, pipe.gold) is None
    assert gold.read_history(spark, pipe.gold) is None
    assert keyed.read_rejects(spark, pipe.gold).count() == 2
    pipe.run((1, "A", "M01", 1.0))
    assert pipe.latest() == {"A": (1, 1.0)}


def test_empty_source_ends_cleanly(spark, tmp_path):
    pipe = Pipe(spark, tmp_path)
    pipe.run()
    assert not [name for name in os.listdir(pipe.silver) if not name.startswith((".", "_"))]
    pipe.run((1, "A", "M01", 1.0))
    assert pipe.latest() == {"A": (1, 1.0)}


def test_one_file_per_micro_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    for minute in range(3):
        _land(spark, source, (minute, "A", "M01", float(minute)))
    runs.wait(
        silver.stream_silver(spark, source, str(tmp_path / "s"), str(tmp_path / "c"), max_files=1)
    )
    assert {r.batch_id for r in spark.read.parquet(str(tmp_path / "s")).collect()} == {0, 1, 2}


def test_micro_batches_bounded_by_size(spark, tmp_path):
    source = str(tmp_path / "in")
    for minute in range(3):
        _land(spark, source, (minute, "A", "M01", float(minute)))
    runs.wait(
        silver.stream_silver(spark, source, str(tmp_path / "s"), str(tmp_path / "c"), max_bytes="1")
    )
    assert {r.batch_id for r in spark.read.parquet(str(tmp_path / "s")).collect()} == {0, 1, 2}
    with pytest.raises(ValueError):
        read_files(spark, source, C.STREAM_BRONZE_SCHEMA, 1, "1")


def test_on_batch_gets_the_staged_rows(spark, tmp_path):
    seen = {}
    pipe = Pipe(spark, tmp_path, on_batch=lambda df, epoch: seen.update({epoch: df.collect()}))
    pipe.run((1, "A", "M01", 1.0), (2, "A", "M02", 2.0), (1, "B", "Q01", 1.0))
    assert [(r.series_id, r.value) for r in seen[0]] == [("A", 2.0)]
    assert tuple(seen[0][0].asDict()) == C.SERVING_COLUMNS


def test_bronze_decodes_and_appends(spark, tmp_path):
    source = str(tmp_path / "in")
    bodies = ['{"series_id":"A","year":"2024","is_latest":true}', "{broken"]
    spark.createDataFrame([(bytearray(b, "utf-8"),) for b in bodies], "value binary").write.parquet(source)
    stream = read_files(spark, source, spark.read.parquet(source).schema)
    for _ in range(2):
        runs.wait(bronze.stream_bronze(stream, str(tmp_path / "b"), str(tmp_path / "c")))
    rows = spark.read.parquet(str(tmp_path / "b"))
    assert sorted((r.series_id or "", r.is_latest) for r in rows.collect()) == [("", False), ("A", True)]
    names = [f for f in os.listdir(tmp_path / "b") if f.endswith(".parquet")]
    assert all(".snappy." in f for f in names)


def test_interval_trigger_and_time_bound(spark, tmp_path):
    source = ensure_folder(spark, str(tmp_path / "in"))
    _land(spark, source, (1, "A", "M01", 1.0))
    query = silver.stream_silver(
        spark, source, str(tmp_path / "s"), str(tmp_path / "c"), every="1 second"
    )
    query.processAllAvailable()
    runs.wait(query, max_seconds=1)
    assert not query.isActive
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1


def test_state_keeps_latest_over_batches(spark, tmp_path):
    source, checkpoint, seen = str(tmp_path / "in"), str(tmp_path / "c"), []

    def run():
        points = messages.type_points(read_files(spark, source, C.STREAM_BRONZE_SCHEMA))
        assert (silver.read_latest_state(spark, checkpoint) is None) == (not seen)
        runs.wait(silver.stream_latest_state(points, checkpoint))
        rows = silver.read_latest_state(spark, checkpoint)
        assert sorted(rows.columns) == sorted(C.STREAM_SILVER_SCHEMA.names)
        seen.append({r.series_id: (r.ts_ingested.minute, r.value) for r in rows.collect()})
        return seen[-1]

    _land(spark, source, (5, "A", "M01", 1.0), (1, "B", "M01", 1.0))
    assert run() == {"A": (5, 1.0), "B": (1, 1.0)}
    _land(spark, source, (2, "A", "M01", 2.0), (3, "B", "M01", 2.0), (1, "C", "M01", 3.0))
    assert run() == {"A": (5, 1.0), "B": (3, 2.0), "C": (1, 3.0)}
    before = silver.read_latest_state(spark, checkpoint, epoch=0).collect()
    assert {r.series_id: (r.ts_ingested.minute, r.value) for r in before} == seen[0]


def test_publish_points(spark, tmp_path):
    payload = '{"Results":{"series":[{"seriesID":"A","data":[{"year":"2024","period":"M01"},{"year":"2023","period":"M01"}]}]}}'
    frame = spark.createDataFrame([(payload,)], "payload string")
    for latest_only, count in ((True, 1), (False, 2)):
        out = str(tmp_path / str(latest_only))
        bronze.publish_points(frame, latest_only, F.lit(_iso(1)), "parquet", {"path": out})
        rows = spark.read.parquet(out).collect()
        assert len(rows) == count and {r.key for r in rows} <= {"A|2024|M01", "A|2023|M01"}


def test_publish_chosen_series_and_years(spark, tmp_path):
    payload = (
        '{"Results":{"series":[{"seriesID":"A","data":[{"year":"2024","period":"M01"},'
        '{"year":"2022","period":"M01"},{"period":"M02"}]},'
        '{"seriesID":"B","data":[{"year":"2024","period":"M01"}]}]}}'
    )
    frame = spark.createDataFrame([(payload,)], "payload string")

    def published(**chosen):
        out = str(tmp_path / "-".join(chosen))
        bronze.publish_points(frame, False, F.lit(_iso(1)), "parquet", {"path": out}, **chosen)
        return {r.key for r in spark.read.parquet(out).collect()}

    assert published(series=["B"]) == {"B|2024|M01"}
    assert published(first_year=2023) == {"A|2024|M01", "B|2024|M01"}
    assert published(series=["A"], last_year=2022) == {"A|2022|M01"}


def test_history_is_looked_up_by_day_and_key(spark, tmp_path):
    def batch(*days):
        rows = [
            (dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc), f"S{d}", 2024, "M01", "n", 1.0, None, True, 1, dt.date(2024, 1, 1))
            for d in days
        ]
        return spark.createDataFrame(rows, C.STREAM_SILVER_SCHEMA)

    root = str(tmp_path / "g")
    gold.write_gold_batch(batch(1, 2, 3), 0, root)
    gold.write_gold_batch(batch(2, 3, 4), 1, root)
    got = sorted((r.series_id, r.version) for r in gold.read_history(spark, root).collect())
    assert got == [("S1", 1), ("S2", 1), ("S3", 1), ("S4", 2)]


def test_history_days_follow_utc(spark, tmp_path):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = (dt.datetime(2024, 1, 2, 3, tzinfo=dt.timezone.utc), "A", 2024, "M01", "n", 1.0, None, True, 1, dt.date(2024, 1, 1))
        batch = spark.createDataFrame([row], C.STREAM_SILVER_SCHEMA)
        gold.write_gold_batch(batch, 0, str(tmp_path / "g"))
        days = [name for _, names, _ in os.walk(tmp_path / "g") for name in names if "ingest_day" in name]
        assert days == ["ingest_day=2024-01-02"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_sketches_of_steps_merge_and_stay(spark, tmp_path):
    """Distinct series and quantiles over all steps, from the sketches alone, also of expired steps."""
    root = str(tmp_path / "g")
    assert gold.read_sketched(spark, root) is None
    base = spark.range(6_000).select(
        F.lit(dt.datetime(2024, 1, 1)).alias("ts_ingested"),
        F.concat(F.lit("S"), F.col("id") % 4_000).alias("series_id"),
        F.lit(2024).alias("year"),
        F.when(F.col("id") % 10 == 0, "Q01").otherwise("M01").alias("period"),
        F.lit("n").alias("periodName"),
        F.col("id").cast("double").alias("value"),
        F.lit(None).cast("array<string>").alias("footnotes"),
        F.lit(True).alias("is_latest"),
        F.when(F.col("id") % 10 > 0, 1).alias("month"),
        F.when(F.col("id") % 10 > 0, F.lit(dt.date(2024, 1, 1))).alias("dt"),
    )
    for epoch in range(3):
        part = base.where(F.floor(F.col("value") / 2_000) == epoch)
        gold.write_gold_batch(part, epoch, root, run="r", fold_every=0)
    gold.write_gold_batch(base.where("period = 'Q01'").limit(5), 3, root, run="r", fold_every=0)

    def check():
        rows = gold.read_sketched(spark, root, ranks=(0.25, 0.5, 1.0))
        found = rows.first()
        assert (found.rows, found.numbers) == (5_400, 5_400)
        assert abs(found["keys"] - 3_600) <= 3 * 3_600 * 1.04 / 64
        assert all(abs(q - want) <= 0.02 * 6_000 for q, want in zip(found.quantiles, (1_500, 3_000, 6_000)))
        kept = keyed.read_kept(spark, root, keyed.SKETCHES)
        assert all("sketches" in path for path in kept.inputFiles()) and kept.count() == 3

    check()
    gold.fold_latest(spark, root)
    gold.compact_history(spark, root, dt.date(2025, 1, 1))
    assert gold.expire_gold(spark, root)
    assert keyed.stamps(spark, root) == [4]
    check()
