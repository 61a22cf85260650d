"""The watermark form: last copy per key and time, then the hour; late rows are counted."""

from __future__ import annotations

import os

from conftest import SF001, msg

from aurum.plans import jobs
from aurum.schemas import HOURLY_SCHEMA
from aurum.sources import streams
from aurum.streaming import windowed


def _land(folder, name, *messages):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(messages) + "\n")


def _drain(spark, root):
    q = windowed.start_windowed_hourly(streams.read_landing(spark, f"{root}/in"), f"{root}/out", f"{root}/cp")
    q.awaitTermination()
    assert not q.exception()
    rows = spark.read.schema(HOURLY_SCHEMA).parquet(f"{root}/out").collect()
    return ({(r["city"], r["hour_start"].hour, r["avg_temp"], r["max_temp"], r["readings"]) for r in rows},
            windowed.dropped_late(q.recentProgress))


def test_last_copy_wins_and_late_rows_are_counted(spark, tmp_path):
    root = str(tmp_path)
    at = "2026-06-25T12:30:00Z"
    _land(f"{root}/in", "a",
          msg("A", event_time=at, t=10.0, fetched="2026-06-25T12:31:00Z"),
          msg("A", event_time=at, t=20.0, fetched="2026-06-25T12:33:00Z"),  # the last fetch
          msg("A", event_time=at, t=15.0, fetched="2026-06-25T12:32:00Z"),
          msg("B", event_time=at, t=1.0), msg("B", event_time=at, t=2.0, fetched=None),  # no fetch time wins
          msg("A", event_time="2026-06-25T12:45:00Z", t=30.0), msg("A", event_time="bad", t=1.0))
    assert _drain(spark, root) == (set(), 0)  # the hour is open
    _land(f"{root}/in", "b", msg("A", event_time=at, t=40.0, fetched="2026-06-25T12:50:00Z"),  # a copy in a later batch
          msg("C", event_time="2026-06-25T16:10:00Z", t=5.0))
    closed, dropped = _drain(spark, root)
    assert closed == {("A", 12, 35.0, 40.0, 2), ("B", 12, 2.0, 2.0, 1)} and dropped == 0
    _land(f"{root}/in", "c", msg("A", event_time=at, t=50.0, fetched="2026-06-25T19:00:00Z"),  # behind the watermark
          msg("D", event_time="2026-06-25T11:00:00Z", t=5.0), msg("E", event_time="2026-06-25T15:30:00Z", t=6.0))
    again, dropped = _drain(spark, root)
    assert again == closed and dropped == 2  # E is within the hour of lateness
    _land(f"{root}/in", "d", msg("Z", event_time="2026-06-26T16:10:00Z"))
    assert _drain(spark, root)[0] == closed | {("C", 16, 5.0, 5.0, 1), ("E", 15, 6.0, 6.0, 1)}


def test_redelivered_range_is_dropped_and_counted(spark):
    plain, q = jobs.run_stream_windowed(spark, SF001)
    replayed, _ = jobs.run_stream_windowed(spark, SF001, replay=True)
    rows = [sorted(map(tuple, spark.read.schema(HOURLY_SCHEMA).parquet(p).collect())) for p in (plain, replayed)]
    assert rows[0] == rows[1] != []
