"""Command line of the jobs: ``spark-submit`` this, or ``python -m tidemark <job>``.

The session, its master and its connector jars come from the launcher.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os

from pyspark.sql import SparkSession

from tidemark.operators import keyed
from tidemark.plans import batch
from tidemark.sources import payloads, streams
from tidemark.streaming import bronze, gold, runs, silver


def _today() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def _stamp() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def _said(seen) -> str:
    return json.dumps({"rows": seen.rows, "rejects": seen.rejects})


def land(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = payloads.read_payloads(spark, a.payloads, a.one_per_line)
    rejects = batch.land_payloads(
        spark, docs, f"{a.raw}/{_stamp()}", a.bronze, a.ingest_date, a.since,
        replace_day=a.replace_day,
    )
    if a.rejects:
        rejects.write.mode("append").text(a.rejects)


def build_silver(spark: SparkSession, a: argparse.Namespace) -> None:
    batch.build_silver(spark, a.bronze, a.silver, a.since, a.until)


def build_gold(spark: SparkSession, a: argparse.Namespace) -> None:
    seen = batch.build_gold(spark, a.silver, a.gold, a.since, a.label, a.until)
    if seen is not None:
        print(_said(seen))


def refresh(spark: SparkSession, a: argparse.Namespace) -> None:
    print(json.dumps({"series": batch.refresh_fact_latest(spark, a.gold, a.view)}))


def serve(spark: SparkSession, a: argparse.Namespace) -> None:
    fact = batch.read_gold(spark, a.gold)
    if fact is None:
        raise SystemExit("the gold table holds nothing")
    latest = gold.read_latest(spark, a.stream_gold) if a.stream_gold else None
    for name, view in batch.build_serving(fact, latest=latest).items():
        view.write.mode("overwrite").parquet(f"{a.out}/{name}")


def compact(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.gold:
        batch.fold_gold(spark, a.gold)
    if a.stream_gold:
        gold.fold_latest(spark, a.stream_gold)
        gold.compact_history(spark, a.stream_gold, a.before)
    if a.silver:
        silver.compact_silver(spark, a.silver, a.keep_epochs)


def expire(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.gold:
        keyed.expire(spark, a.gold, a.keep)
    if a.stream_gold:
        gold.expire_gold(spark, a.stream_gold, a.keep)
    if a.silver:
        silver.expire_silver(spark, a.silver, a.keep_epochs)


def _bootstrap(a: argparse.Namespace) -> str:
    return streams.bootstrap_servers(a.bootstrap, os.getenv("KAFKA_BOOTSTRAP"))


def publish(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = payloads.read_payloads(spark, a.payloads, a.one_per_line)
    options = streams.kafka_sink_options(_bootstrap(a), a.topic)
    bronze.publish_points(
        docs, a.latest_only, sink_options=options,
        series=a.series, first_year=a.first_year, last_year=a.last_year,
    )


def _every(a: argparse.Namespace) -> str | None:
    return None if a.drain else f"{a.trigger_seconds} seconds"


def _bound(a: argparse.Namespace) -> int:
    return 0 if a.drain else a.max_seconds


def stream_bronze(spark: SparkSession, a: argparse.Namespace) -> None:
    options = streams.kafka_options(_bootstrap(a), a.topic, a.start, a.max_offsets)
    source = streams.read_kafka(spark, options)
    runs.wait(bronze.stream_bronze(source, a.bronze, a.checkpoint, _every(a)), _bound(a))


def stream_silver(spark: SparkSession, a: argparse.Namespace) -> None:
    query = silver.stream_silver(
        spark, a.bronze, a.silver, a.checkpoint, _every(a), a.max_files, a.max_bytes, a.archive
    )
    runs.wait(query, _bound(a))


def stream_gold(spark: SparkSession, a: argparse.Namespace) -> None:
    query = gold.stream_gold(
        spark, a.silver, a.gold, a.checkpoint, _every(a), a.max_files, a.max_bytes,
        guard_recency=not a.incoming_wins, archive=a.archive,
        on_measures=lambda seen, epoch: print(epoch, _said(seen), flush=True),
    )
    runs.wait(query, _bound(a))


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tidemark")
    jobs = root.add_subparsers(required=True, metavar="job")

    def job(name, run, *needed):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for option in needed:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def stream(name, run, seconds, bound, *needed):
        sub = job(name, run, *needed, "checkpoint")
        sub.add_argument("--trigger-seconds", type=int, default=seconds)
        sub.add_argument("--max-seconds", type=int, default=bound, help="0 or less: no bound")
        sub.add_argument("--drain", action="store_true", help="process what is there and end")
        return sub

    def file_bounds(sub):
        sub.add_argument("--max-files", type=int)
        sub.add_argument("--max-bytes")
        sub.add_argument("--archive", help="move read files here")

    def broker(sub):
        sub.add_argument("--bootstrap")
        sub.add_argument("--topic", required=True)

    sub = job("land", land, "payloads", "raw", "bronze")
    sub.add_argument("--one-per-line", action="store_true")
    sub.add_argument("--ingest-date", type=dt.date.fromisoformat, default=_today())
    sub.add_argument("--since", help="drop records before this year or year and month")
    sub.add_argument("--replace-day", action="store_true")
    sub.add_argument("--rejects")
    sub = job("silver", build_silver, "bronze", "silver")
    sub.add_argument("--since", type=dt.date.fromisoformat, help="first ingest date to rebuild")
    sub.add_argument("--until", type=dt.date.fromisoformat, help="last ingest date to rebuild")
    sub = job("gold", build_gold, "silver", "gold")
    sub.add_argument("--since", type=dt.date.fromisoformat, help="first ingest date to stage")
    sub.add_argument("--until", type=dt.date.fromisoformat, help="last ingest date to stage")
    sub.add_argument("--label", help="name of this run; one that is committed is not repeated")
    job("refresh", refresh, "gold", "view")
    sub = job("serve", serve, "gold", "out")
    sub.add_argument("--stream-gold", help="also serve the stream's latest table")
    for name, run in (("compact", compact), ("expire", expire)):
        sub = job(name, run)
        sub.add_argument("--gold", help="batch table")
        sub.add_argument("--stream-gold", help="stream table")
        sub.add_argument("--silver", help="stream silver")
        sub.add_argument("--keep-epochs", type=int, default=20, help="silver epochs to leave as they are")
        if name == "compact":
            sub.add_argument("--before", type=dt.date.fromisoformat, help="first day that is not closed")
    sub.add_argument("--keep", type=int, default=1, help="bases to keep")
    sub = job("publish", publish, "payloads")
    sub.add_argument("--one-per-line", action="store_true")
    sub.add_argument("--latest-only", action="store_true")
    sub.add_argument("--series", nargs="+", help="publish these only")
    sub.add_argument("--first-year", type=int)
    sub.add_argument("--last-year", type=int)
    broker(sub)
    sub = stream("stream-bronze", stream_bronze, runs.BRONZE_SECONDS, runs.BRONZE_BOUND, "bronze")
    sub.add_argument("--start", choices=streams.STARTS, default="latest")
    sub.add_argument("--max-offsets", type=int)
    broker(sub)
    sub = stream(
        "stream-silver", stream_silver, runs.SILVER_SECONDS, runs.SILVER_BOUND, "bronze", "silver"
    )
    file_bounds(sub)
    sub = stream("stream-gold", stream_gold, runs.GOLD_SECONDS, runs.GOLD_BOUND, "silver", "gold")
    file_bounds(sub)
    sub.add_argument("--incoming-wins", action="store_true", help="a late older row may win")
    return root


def main(arguments: list[str] | None = None) -> None:
    chosen = parser().parse_args(arguments)
    chosen.run(SparkSession.builder.appName("tidemark").getOrCreate(), chosen)


if __name__ == "__main__":
    main()
