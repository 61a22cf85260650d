"""Batch-level medallion steps shared by batch backfills and micro-batches:
silver insert-if-absent (T7), incremental gold refresh (X2, T8-T10), repair of
days and the full rebuild (T12).

Inserted rows are folded into mergeable states (``operators.partials``) on their
way to silver; the refresh takes the states of the (key, day) pairs that a batch
touches and replaces their gold rows.  Late and re-delivered rows give the same
gold as a rebuild, because the states always stand for silver as it is.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import gold, merge, partials
from ..sources.store import MedallionStore

log = logging.getLogger(__name__)

#: More day ranges than this are read as one range.
MAX_SPANS = 32


def batch_summary(batch_silver: DataFrame, cfg) -> dict:
    """One small job: row count, touched days with their first and last time, and
    touched latest-buckets of a silver batch (one row a day, bucket ids at most the
    bucket count)."""
    per_day = batch_silver.groupBy("day").agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_time").alias("lo"), F.max("event_time").alias("hi"),
        F.collect_set(gold.latest_bucket(F.col("city"), cfg)).alias("buckets")).collect()
    per_day = sorted(per_day, key=lambda r: r["day"])
    return {"rows": sum(r["rows"] for r in per_day), "days": [r["day"] for r in per_day],
            "spans": [(r["lo"], r["hi"]) for r in per_day],
            "buckets": sorted({b for r in per_day for b in r["buckets"]})}


def _is_kept(df: DataFrame) -> bool:
    """Has the caller persisted these rows?"""
    level = df.storageLevel
    return level.useMemory or level.useDisk


def _from_day(summary: dict, first: str) -> dict:
    """The summary without days that retention has dropped."""
    kept = [(d, s) for d, s in zip(summary["days"], summary["spans"]) if str(d) >= first]
    return {**summary, "days": [d for d, _ in kept], "spans": [s for _, s in kept]}


def _within(spans: list) -> Column:
    """Stored rows with a batch row's time lie in its days' time ranges.  The scan
    skips row groups outside, so keys are compared with a part of the day only."""
    if len(spans) > MAX_SPANS:
        spans = [(min(lo for lo, _ in spans), max(hi for _, hi in spans))]
    out = F.lit(False)
    for lo, hi in spans:
        out = out | F.col("event_time").between(F.lit(lo), F.lit(hi))
    return out


def write_silver(lake: MedallionStore, silver_batch: DataFrame, summary: dict | None = None) -> int:
    """Insert-if-absent on (city, event_time); first write wins across
    batches (the batch itself is already keep-last de-duplicated).  ``summary``
    (from ``batch_summary``) saves a job when known; its row count allows
    broadcasting the batch keys.  Returns the rows inserted, those that a
    job which died had begun to insert included."""
    lake.layout()
    partials.ensure(lake)
    inserted = partials.recover(lake)
    # several passes read the batch: evaluate it once, unless the caller does (and goes on using it)
    own = summary is None and not _is_kept(silver_batch)
    if own:
        silver_batch = silver_batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if summary is None:
            summary = batch_summary(silver_batch, lake.cfg)
        rows = lake.conform("silver", silver_batch)
        kept_from = lake.silver_from()
        if kept_from is not None:  # rows of days that retention has dropped
            late = rows.where(F.col("day") < F.lit(kept_from).cast("date"))
            if not late.isEmpty():
                merge.write_partitioned(late.select(*lake.schema("late").names), lake.path("late"),
                                        "day", "append")
            rows = rows.where(F.col("day") >= F.lit(kept_from).cast("date"))
            summary = _from_day(summary, kept_from)
        if not summary["days"]:
            return inserted
        small = summary["rows"] <= lake.cfg.broadcast_touched_rows
        new = merge.merge_plan(lake.spark, lake.path("silver"), rows, ["city", "event_time"], "day", "ignore",
                               lake.schema("silver"), summary["days"], small_updates=small,
                               within=_within(summary["spans"]))
        return inserted + partials.insert(lake, new)
    finally:
        if own:
            silver_batch.unpersist()


def refresh_gold(lake: MedallionStore, batch_silver: DataFrame, days: list | None = None,
                 summary: dict | None = None) -> int:
    """Gold rows of the touched (city, day) pairs from their states.  ``days``
    limits the refresh to some days (the reference's today-only timer path);
    default: every touched day.  ``summary`` (from ``batch_summary``) saves a job
    when already known.  Returns the number of touched days."""
    cfg = lake.cfg
    lake.layout()
    partials.ensure(lake)
    kept_from = lake.silver_from()
    if kept_from is not None:  # older gold cannot be recomputed any more
        batch_silver = batch_silver.where(F.col("day") >= F.lit(kept_from).cast("date"))
        if summary is not None:
            summary = _from_day(summary, kept_from)
    if days is not None:
        batch_silver = batch_silver.where(F.col("day").isin(days))
        summary = None
    if summary is None:
        summary = batch_summary(batch_silver, cfg)
    touched_days = summary["days"]
    if not touched_days:
        return 0
    touched = batch_silver.select("city", "day").distinct()
    if len(touched_days) > cfg.max_touched_days_warn:
        log.warning("batch touches %d day partitions; their states are read and gold rewritten",
                    len(touched_days))
    small = summary["rows"] <= cfg.broadcast_touched_rows   # pairs <= rows: a proven bound
    states = (lake.table("partials").read(touched_days)
              .join(F.broadcast(touched) if small else touched, ["city", "day"], "left_semi")
              .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        # proven bounds: latest rows <= touched keys <= batch rows, daily rows =
        # touched pairs <= batch rows, hourly rows <= 24 x touched pairs
        latest = lake.conform("latest", gold.with_latest_bucket(partials.latest(states), cfg))
        hourly = lake.conform("hourly", partials.hourly(states, cfg))
        daily = lake.conform("daily", partials.daily(states, cfg))
        jobs = [
            lambda: merge.merge_keyed(
                lake.spark, lake.path("latest"), latest, ["city"], "bucket",
                "replace_if_newer", lake.schema("latest"), time_col="event_time",
                values=summary["buckets"], small_updates=small, unique=True),
            lambda: merge.merge_keyed(
                lake.spark, lake.path("hourly"), hourly, ["city", "hour_start"], "day",
                "replace", lake.schema("hourly"), values=touched_days,
                small_updates=24 * summary["rows"] <= cfg.broadcast_touched_rows, unique=True),
            lambda: merge.merge_keyed(
                lake.spark, lake.path("daily"), daily, ["city", "day"], "day", "replace",
                lake.schema("daily"), values=touched_days, small_updates=small, unique=True),
        ]
        # three independent tables from the same persisted inputs: submit the
        # jobs together so small batches do not pay three job latencies in a row
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            # inherit the stream's job group, so that stopping it cancels them
            for f in [pool.submit(inheritable_thread_target(j)) for j in jobs]:
                f.result()
    finally:
        states.unpersist()
    return len(touched_days)


def repair_pairs(lake: MedallionStore, touched: DataFrame) -> int:
    """Recompute the states of some (city, day) pairs from all of their silver
    rows, then their gold.  For pairs whose states or gold are known to be wrong;
    returns the number of days."""
    lake.layout()
    partials.ensure(lake)
    partials.recover(lake)
    touched = touched.select("city", "day").distinct().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counted = touched.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()
        days, small = sorted(r["day"] for r in counted), sum(r["n"] for r in counted) <= lake.cfg.broadcast_touched_rows
        if days:
            partials.recompute(lake, touched, days, small)
            refresh_gold(lake, touched.withColumn("event_time", F.col("day").cast("timestamp")))
        return len(days)
    finally:
        touched.unpersist()


def rebuild_gold(lake: MedallionStore) -> None:
    """Recompute the states from silver, then all gold tables from them, and
    replace them (repair path; must equal the incremental result).  Silver is read
    once.  Each new table is written beside the old one and switched to when whole,
    so a rebuild that dies leaves the old rows readable."""
    cfg = lake.cfg
    partials.recover(lake)
    partials.rebuild(lake)
    states = lake.read("partials")
    outputs = {
        "latest": gold.with_latest_bucket(partials.latest(states), cfg),
        "hourly": partials.hourly(states, cfg),
        "daily": partials.daily(states, cfg),
    }
    for name, df in outputs.items():
        lake.table(name).replace(lake.conform(name, df), None)
