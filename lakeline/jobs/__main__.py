"""Command line of the pipeline: ``python -m lakeline.jobs <job> ...`` or spark-submit.

    stream         landing JSON lines -> day-partitioned lake, one bounded drain
    load           one landing day -> raw tables
    speed          landing JSON lines -> hourly sums per city, merged level by level
    backlog        fails if the newest backlog of a subscription is high or growing
    vacuum         forget old versions of tables and delete what none of them names
    daily-summary  one UTC day of the lake -> date=<day>
    compact        merge the small files of one lake day
    transform      raw tables -> marts (incremental fact), then all checks
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import SparkSession

from ..operators.compaction import compact
from ..operators.joins import hot_keys
from ..operators.quality import assert_checks, run_checks
from ..operators.series import assert_no_backlog
from ..plans import daily
from ..plans.checks import model_checks
from ..plans.models import run_transform
from ..schemas import ORDERS, PAYMENTS, TOPICS, required
from ..session import build_session, use_utc
from ..sources import landing, lake
from ..sources.ledger import Ledger
from ..streaming.dedup import SPREAD
from ..streaming.drain import ingest_topic
from ..streaming.hourly import FAN, drain_hourly_levels
from ..streaming.writer import BatchWriter

log = logging.getLogger("lakeline")


def yesterday() -> str:
    return (dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=1)).date().isoformat()


def run_stream(spark: SparkSession, a) -> dict:
    lake_path = f"{a.lake}/{a.topic}"
    run = ingest_topic(
        spark, a.topic, f"{a.landing}/{a.topic}", lake_path, f"{a.checkpoints}/{a.topic}",
        quarantine=f"{a.quarantine or a.lake + '-quarantine'}/{a.topic}",
        metrics=a.metrics or f"{a.lake}-metrics", max_bad=a.max_bad,
        writer=BatchWriter(lake_path, on_missing=a.on_missing), max_files=a.max_files,
        max_bytes=a.max_bytes, delay=a.delay, spread=a.spread,
    )
    log.warning("stream %s: %s", a.topic, run)
    return run


def run_load(spark: SparkSession, a) -> dict[str, int]:
    loaded = {
        topic: landing.load_day(spark, f"{a.landing}/{topic}", f"{a.raw}/{topic}", schema, a.date,
                                a.mode, a.max_bad)
        for topic, (schema, _) in TOPICS.items()
    }
    log.warning("loaded %s: %s", a.date, loaded)
    return loaded


def run_speed(spark: SparkSession, a) -> list[dict]:
    """Hourly sums per city of what has arrived since the last run, bad records left out."""
    stream = landing.read_events(spark, f"{a.landing}/orders", ORDERS, a.max_files,
                                 max_bytes=a.max_bytes)
    good, _ = landing.split_corrupt(stream, required(ORDERS))
    batches = drain_hourly_levels(good, a.sums, f"{a.checkpoints}/speed", a.fan)
    log.warning("speed layer: %s batches", len(batches))
    return batches


def run_backlog(spark: SparkSession, a) -> int:
    checked = assert_no_backlog(spark.read.parquet(a.samples), a.high, a.floor)
    log.warning("%s subscriptions without alerts", checked)
    return checked


def run_vacuum(spark: SparkSession, a) -> int:
    older = dt.timedelta(hours=a.older_than_hours)
    deleted = sum(Ledger(spark, path).vacuum(a.keep, older) for path in a.tables)
    log.warning("deleted %s folders that no version names", deleted)
    return deleted


def run_daily_summary(spark: SparkSession, a) -> str:
    payments = lake.read_day(spark, f"{a.lake}/payments", a.date, PAYMENTS)
    summary = daily.daily_summary(
        lake.read_day(spark, f"{a.lake}/orders", a.date, ORDERS), payments, a.date,
        hot_orders=hot_keys(payments, "order_id"),
    )
    return lake.overwrite_partition(summary, a.output, "date", a.date)


def run_compact(spark: SparkSession, a) -> dict:
    topics = list(TOPICS) if a.table == "all" else [a.table]
    done = {t: compact(spark, f"{a.lake}/{t}", a.date, a.target_mib * 2**20) for t in topics}
    for topic, result in done.items():
        log.warning("compact %s %s: %s", topic, a.date, result)
    return done


def run_transform_job(spark: SparkSession, a) -> int:
    raw = {t: landing.read_raw(spark, f"{a.raw}/{t}", schema, with_load_date=True)
           for t, (schema, _) in TOPICS.items()}
    models = run_transform(spark, raw, a.warehouse, full_refresh=a.full_refresh,
                           reach_days=a.reach_days)
    return assert_checks(run_checks(models, model_checks()))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lakeline.jobs")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, *paths):
        p = jobs.add_parser(name)
        p.set_defaults(run=run)
        for path in paths:
            p.add_argument(f"--{path}", required=True)
        return p

    p = job("stream", run_stream, "landing", "lake", "checkpoints")
    p.add_argument("topic", choices=list(TOPICS))
    p.add_argument("--quarantine", help="default: the lake's folder with -quarantine")
    p.add_argument("--metrics", help="default: the lake's folder with -metrics")
    p.add_argument("--max-bad", type=int, help="fail the run beyond so many new bad records")
    p.add_argument("--max-files", type=int, default=50)
    p.add_argument("--max-bytes", type=int, help="limit batches by bytes instead of files")
    p.add_argument("--delay", default="10 minutes", help="how late a row may be")
    p.add_argument("--spread", type=int, default=SPREAD)
    p.add_argument("--on-missing", choices=["fail", "skip"], default="fail")
    p = job("load", run_load, "landing", "raw")
    p.add_argument("--date", default=yesterday())
    p.add_argument("--mode", choices=["append", "replace_day"], default="append")
    p.add_argument("--max-bad", type=int, default=0)
    p = job("speed", run_speed, "landing", "sums", "checkpoints")
    p.add_argument("--max-files", type=int, default=50)
    p.add_argument("--max-bytes", type=int, help="limit batches by bytes instead of files")
    p.add_argument("--fan", type=int, default=FAN, help="folders of a level that become one")
    p = job("backlog", run_backlog, "samples")
    p.add_argument("--high", type=int, default=50_000)
    p.add_argument("--floor", type=int, default=5_000)
    p = job("vacuum", run_vacuum)
    p.add_argument("tables", nargs="+")
    p.add_argument("--keep", type=int, default=10, help="versions that stay readable")
    p.add_argument("--older-than-hours", type=float, default=24)
    p = job("daily-summary", run_daily_summary, "lake", "output")
    p.add_argument("--date", default=yesterday())
    p = job("compact", run_compact, "lake")
    p.add_argument("--date", default=yesterday())
    p.add_argument("--table", choices=[*TOPICS, "all"], default="all")
    p.add_argument("--target-mib", type=int, default=128)
    p = job("transform", run_transform_job, "raw", "warehouse")
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--reach-days", type=int, help="read only loads of so many days before the bound")
    return top


def main(argv: list[str] | None = None):
    args, _ = parser().parse_known_args(argv)
    return args.run(use_utc(build_session(f"lakeline-{args.job}")), args)


if __name__ == "__main__":
    main()
