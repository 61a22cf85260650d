"""Command line:

    python -m aurum.cli stream   --store ROOT --checkpoint DIR (--landing DIR | --kafka HOST:PORT --topic T)
                                 [--trigger "30 seconds" | --available-now]
    python -m aurum.cli tiers    --store ROOT --checkpoint DIR (--landing DIR | --kafka ...)
                                 [--bronze-every 10] [--silver-every 30] [--gold-every 60] [--today-only]
    python -m aurum.cli show     QUERY --store ROOT [--cities a,b] [--hours N] [--limit N] [--ascending]
    python -m aurum.cli rebuild  --store ROOT
    python -m aurum.cli compact  --store ROOT --table silver --days 2026-06-24,2026-06-25 [--by key]
    python -m aurum.cli merge-bronze --store ROOT
    python -m aurum.cli add-column --store ROOT --table silver --name checked --type STRING --default "'no'"
    python -m aurum.cli retention --store ROOT --table silver --before 2026-01-01

The session comes from ``SparkSession.builder.getOrCreate()`` (spark-submit
settings apply); the clock is pinned to UTC.
"""

from __future__ import annotations

import argparse
import datetime as dt
import zoneinfo

from pyspark.sql import SparkSession

from . import session
from .operators import incremental, lookups
from .plans import serve
from .plans.tables import Tables
from .sources import streams
from .sources.store import MedallionStore
from .streaming import medallion

SHOW = {
    "city_latest": lambda t, a: serve.city_latest(t),
    "daily_stats": lambda t, a: serve.daily_stats(t),
    "hourly_stats": lambda t, a: serve.hourly_stats(t),
    "recent_readings": lambda t, a: serve.recent_readings(t, a.hours or 24),
    "latest_full": lambda t, a: serve.latest_full(t),
    "alerts": lambda t, a: serve.alerts(t, cities=a.cities),
    "kpi_row": lambda t, a: serve.kpi_row(t, a.cities),
    "ranked_cards": lambda t, a: serve.ranked_cards(t, a.cities, a.ascending),
    "map_points": lambda t, a: serve.map_points(t, lookups.city_dim(t.latest.sparkSession),
                                                a.cities, fixed_size=True),
    "spotlight": lambda t, a: serve.spotlight(t, a.cities[0] if a.cities else serve.hottest_key(t)),
    "trend": lambda t, a: serve.trend(t, a.hours or 12, a.cities),
    "daily_flag_labels": lambda t, a: serve.daily_flag_labels(t, a.cities),
    "hour_pivot": lambda t, a: serve.hour_pivot(t, a.cities),
    "heatwave_days": lambda t, a: serve.heatwave_days(t),
    "newest_readings": lambda t, a: serve.newest_readings(t, a.limit or 20),
}


def _source(spark, a):
    if a.kafka:
        return streams.read_kafka(spark, a.kafka, a.topic)
    return streams.read_landing(spark, a.landing, a.max_files)


def _days(text: str) -> list:
    return [dt.date.fromisoformat(d.strip()) for d in text.split(",") if d.strip()]


def _today_only(store):
    """The days a gold refresh covers: the current one, by the business zone."""
    zone = zoneinfo.ZoneInfo(store.cfg.tz)
    return lambda: [dt.datetime.now(zone).date()]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="aurum")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("stream", "tiers"):
        s = sub.add_parser(name)
        s.add_argument("--store", required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--landing")
        s.add_argument("--kafka")
        s.add_argument("--topic", default="readings")
        s.add_argument("--max-files", type=int, default=1000,
                       help="landing files per micro-batch")
        s.add_argument("--available-now", action="store_true")
        if name == "stream":
            s.add_argument("--trigger", default=None, help='e.g. "30 seconds"')
        else:
            s.add_argument("--bronze-every", type=int, default=10)
            s.add_argument("--silver-every", type=int, default=30)
            s.add_argument("--gold-every", type=int, default=60)
            s.add_argument("--today-only", action="store_true",
                           help="refresh gold for the current day only")
    s = sub.add_parser("show")
    s.add_argument("query", choices=sorted(SHOW))
    s.add_argument("--store", required=True)
    s.add_argument("--cities", type=lambda v: [c for c in v.split(",") if c], default=None)
    s.add_argument("--hours", type=int, default=None)
    s.add_argument("--limit", type=int, default=None)
    s.add_argument("--ascending", action="store_true", help="ranked_cards: coolest first")
    s.add_argument("--rows", type=int, default=50)
    s = sub.add_parser("rebuild")
    s.add_argument("--store", required=True)
    s = sub.add_parser("compact")
    s.add_argument("--store", required=True)
    s.add_argument("--table", default="silver")
    s.add_argument("--days", required=True)
    s.add_argument("--by", choices=("time", "key"), default="time")
    s = sub.add_parser("merge-bronze")
    s.add_argument("--store", required=True)
    s = sub.add_parser("add-column")
    for option in ("--store", "--table", "--name", "--type"):
        s.add_argument(option, required=True)
    s.add_argument("--default", default="NULL")
    s = sub.add_parser("retention")
    s.add_argument("--store", required=True)
    s.add_argument("--table", default="silver")
    s.add_argument("--before", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    a = parser().parse_args(argv)
    spark = session.prepare(spark or SparkSession.builder.getOrCreate())
    store = MedallionStore(spark, a.store)
    if a.cmd == "stream":
        trig = {"availableNow": True} if a.available_now or not a.trigger else \
            {"processingTime": a.trigger}
        q = medallion.start_medallion(_source(spark, a), store, a.checkpoint, trig)
        q.awaitTermination()
        return q
    if a.cmd == "tiers":
        if a.available_now:
            medallion.run_tiers_available_now(spark, _source(spark, a), store, a.checkpoint)
            return None
        cp = a.checkpoint.rstrip("/")
        qs = [medallion.start_bronze(_source(spark, a), store, f"{cp}/bronze",
                                     {"processingTime": f"{a.bronze_every} seconds"}),
              medallion.start_silver(spark, store, f"{cp}/silver",
                                     {"processingTime": f"{a.silver_every} seconds"}),
              medallion.start_gold(spark, store, f"{cp}/gold",
                                   {"processingTime": f"{a.gold_every} seconds"},
                                   _today_only(store) if a.today_only else None)]
        spark.streams.awaitAnyTermination()
        return qs
    if a.cmd == "show":
        df = SHOW[a.query](Tables.from_store(store), a)
        df.show(a.rows, truncate=False)
        return df
    if a.cmd == "rebuild":
        incremental.rebuild_gold(store)
        return None
    if a.cmd == "compact":
        return store.compact(a.table, _days(a.days), a.by)
    if a.cmd == "merge-bronze":
        return store.merge_bronze(force=True)
    if a.cmd == "add-column":
        return store.add_column(a.table, a.name, a.type, a.default)
    if a.cmd == "retention":
        return store.drop_days_before(a.table, dt.date.fromisoformat(a.before))
    return None


if __name__ == "__main__":
    main()
