"""Work that several queries share is done once: scans, typing, joins with partitions that are new."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF001, messages_df, msg
from pyspark.sql import functions as F

from aurum.config import Config
from aurum.functions import parse, times
from aurum.operators import incremental, merge, silver
from aurum.plans import dirty, jobs, registry  # noqa: F401
from aurum.sources import streams
from aurum.sources.store import MedallionStore
from aurum.sources.versioned import Versioned
from aurum.streaming import medallion


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _silver(spark, lake, values):
    return silver.to_silver(parse.parse_messages(messages_df(spark, values)), lake.cfg)


@pytest.mark.parametrize("mode", ["replace", "replace_if_newer"])
def test_new_partitions_need_no_join(spark, tmp_path, mode):
    lake = MedallionStore(spark, str(tmp_path / "lake")).ensure_tables()
    rows = _silver(spark, lake, [msg(), msg("Delhi", t=20.0)])
    args = (spark, lake.path("silver"), rows, ["city", "event_time"], "day", mode, lake.schema("silver"))
    new = merge.merge_plan(*args, [dt.date(2026, 6, 25)], "event_time")
    assert "Join" not in _plan(new) and new.count() == 2
    incremental.write_silver(lake, rows)
    assert "Join" in _plan(merge.merge_plan(*args, [dt.date(2026, 6, 25)], "event_time"))
    assert lake.table("silver").stored([dt.date(2026, 6, 24)]) is None
    with pytest.raises(ValueError):
        merge.merge_plan(*args[:5], "replace_if_newer", args[6], [dt.date(2026, 6, 24)])


def test_large_batches_fold_without_a_join(spark, tmp_path, monkeypatch):
    """Hours known before, new ones and days that are new, with nothing small enough to broadcast."""
    lake = MedallionStore(spark, str(tmp_path / "lake"), Config(broadcast_touched_rows=0)).ensure_tables()
    plans, replace = [], Versioned.replace

    def seen(self, rows, *args, **kw):
        if self.path.endswith("partials"):
            plans.append(_plan(rows))
        replace(self, rows, *args, **kw)

    monkeypatch.setattr(Versioned, "replace", seen)
    for values in ([msg("A", "2026-06-25T03:10", t=1.0), msg("B", "2026-06-25T03:10", t=2.0)],
                   [msg("A", "2026-06-25T03:40", t=4.0), msg("A", "2026-06-25T05:00", t=7.5), msg("C", "2026-06-26T00:00")]):
        rows = _silver(spark, lake, values)
        incremental.write_silver(lake, rows)
        incremental.refresh_gold(lake, rows)
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    read = lambda: {n: sorted((tuple(r) for r in lake.read(n).drop("ingested_at").collect()), key=repr)
                    for n in ("partials", "latest", "hourly", "daily")}
    got = read()
    assert [(r.city, r.readings, r.avg_temp) for r in lake.read("daily").orderBy("city").collect()] == [
        ("A", 3, 4.17), ("B", 1, 2.0), ("C", 1, 37.6)]
    incremental.rebuild_gold(lake)
    assert read() == got


def test_a_batch_is_typed_once(spark, tmp_path, fx2, monkeypatch):
    lake = MedallionStore(spark, str(tmp_path / "lake")).ensure_tables()
    above, to_silver = [], silver.to_silver

    def seen(typed, cfg):
        above.append(_plan(typed).split("InMemoryRelation")[0])  # what is done on the kept rows
        return to_silver(typed, cfg)

    monkeypatch.setattr(silver, "to_silver", seen)
    compressed = spark.conf.get("spark.sql.inMemoryColumnarStorage.compressed")
    row = medallion.process_batch(lake, fx2.unionByName(messages_df(spark, ["[1]", None])), 0)
    assert row["messages_in"] == 8 and row["malformed"] == 2 and row["silver_inserted"] == 3
    assert len(above) == 1 and "inf(inity)?" not in above[0] and "from_json" not in above[0]
    assert spark.conf.get("spark.sql.inMemoryColumnarStorage.compressed") == compressed


def test_offsets_are_honoured_in_both_zones(spark):
    df = spark.createDataFrame([("2026-06-25T12:30+05:30",), ("2026-06-25 07:00:00Z",), ("2026-06-25T07:00",), ("12:30",)], "s string")
    texts = lambda tz: [r[0] for r in df.select(times.parse_event_time(F.col("s"), tz).cast("string")).collect()]
    assert texts("UTC") == ["2026-06-25 07:00:00"] * 3 + [None]
    assert texts("Asia/Kolkata") == ["2026-06-25 07:00:00"] * 2 + ["2026-06-25 01:30:00", None]


def test_parts_of_the_landing_share_a_scan(spark, tmp_path, monkeypatch):
    parts, write = [], streams.write_messages

    def seen(messages, *args):
        parts.append("InMemoryRelation" in _plan(messages))
        write(messages, *args)

    monkeypatch.setattr(streams, "write_messages", seen)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    jobs._land_batches(spark, SF001, str(tmp_path / "landing"))
    assert parts == [True] * 4
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


@pytest.mark.parametrize("name, where, step, calls", [
    ("insert_if_absent", incremental, "write_silver", 2), ("dirty_batch", medallion, "process_batch", 3)])
def test_rows_loaded_again_are_made_once(spark, monkeypatch, name, where, step, calls):
    kept, run = [], getattr(where, step)

    def seen(lake, rows, *args):
        kept.append("InMemoryRelation" in _plan(rows))
        return run(lake, rows, *args)

    monkeypatch.setattr(where, step, seen)
    assert registry.QUERIES[name](spark, SF001).count() > 0
    assert kept == [True] * calls
