"""States of the roll-ups: folded once for each inserted row, whatever dies; a batch's cost is its own."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import msg
from pyspark.sql import functions as F

from aurum import session
from aurum.config import Config
from aurum.functions import parse
from aurum.operators import incremental, merge, partials, silver
from aurum.sources.store import MedallionStore

DAY = dt.date(2026, 6, 25)


class Killed(Exception):
    pass


def _lake(spark, root, **cfg):
    return MedallionStore(spark, f"{root}/lake", Config(latest_buckets=2, **cfg)).ensure_tables()


def _rows(spark, lake, messages):
    typed = parse.parse_messages(spark.createDataFrame([(m,) for m in messages], "value string"))
    return silver.to_silver(typed, lake.cfg)


def _load(spark, lake, *messages):
    rows = _rows(spark, lake, messages)
    n = incremental.write_silver(lake, rows)
    incremental.refresh_gold(lake, rows)
    return n


def _all(lake, names=("silver", "partials", "latest", "hourly", "daily")):
    return {n: sorted((tuple(r) for r in lake.read(n).drop("ingested_at").collect()), key=repr) for n in names}


def _equals_rebuild(lake):
    got = _all(lake)
    incremental.rebuild_gold(lake)
    assert _all(lake) == got
    return got


FIRST = [msg(c, f"2026-06-{d}T{h:02d}:10", t=10.0 + h) for c in "AB" for d in (24, 25) for h in (3, 4)]
SECOND = [msg("A", "2026-06-25T04:10", t=59.0), msg("A", "2026-06-25T04:40", t=33.33), msg("C", "2026-06-24T00:00", t=-5.5)]


@pytest.mark.parametrize("step", ["pending", "fold", "silver", "remove"])
def test_insert_killed_at_each_step(spark, tmp_path, monkeypatch, step):
    """A replay gives the same tables as a run that lives, wherever the first one died."""
    lake = _lake(spark, tmp_path)
    assert _load(spark, lake, *FIRST) == 8
    before = _all(lake)
    write, delete = merge.write_partitioned, session.delete

    def die(*a, **k):
        raise Killed

    with monkeypatch.context() as m:
        if step == "pending":  # the folder has files, but is not whole
            m.setattr(partials, "_finish", die)
        elif step == "fold":
            m.setattr(partials, "_fold", die)
        elif step == "silver":  # half of the rows have come through
            m.setattr(merge, "write_partitioned", lambda df, *a: (write(df.where("city = 'C'"), *a), die()))
        else:
            m.setattr(session, "delete", lambda s, p: die() if "/pending/" in p else delete(s, p))
        with pytest.raises(Killed):
            _load(spark, lake, *SECOND)
    if step == "pending":
        folder = f"{lake.root}/pending/{partials._pending(lake)[0]}"
        session.delete(spark, f"{folder}/_SUCCESS")
    if step in ("pending", "fold"):
        assert _all(lake) == before
    assert _load(spark, lake, *SECOND) == 2 and partials._pending(lake) == []  # the replay
    assert _load(spark, lake, *SECOND) == 0  # and one after all went well
    got = _equals_rebuild(lake)
    assert len(got["silver"]) == 10
    assert {(r[0], r[5], r[3]) for r in got["daily"] if r[0] == "C"} == {("C", False, -5.5)}


def test_another_batch_takes_up_what_was_left(spark, tmp_path, monkeypatch):
    """Rows of a batch that died are inserted by the next one; its own replay refreshes their gold."""
    lake = _lake(spark, tmp_path)
    with monkeypatch.context() as m:
        m.setattr(merge, "write_partitioned", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            _load(spark, lake, *FIRST)
    assert lake.read("silver").count() == 0 and lake.read("partials").count() == 8
    assert _load(spark, lake, *SECOND) == 8 + 2  # A 04:10 is known by now
    assert _load(spark, lake, *FIRST) == 0
    _equals_rebuild(lake)


def test_rebuild_and_repair_after_a_death(spark, tmp_path, monkeypatch):
    lake = _lake(spark, tmp_path)
    _load(spark, lake, *FIRST)
    with monkeypatch.context() as m:
        m.setattr(merge, "write_partitioned", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            _load(spark, lake, *SECOND)
    incremental.rebuild_gold(lake)
    assert lake.read("silver").count() == 10
    want = _equals_rebuild(lake)
    wrong = lake.read("partials").withColumn("total", (F.col("total") + 7).cast(partials.TOTAL)).where("hour(hour_start) <> 3")
    lake.table("partials").replace(wrong, None)
    pairs = lake.read("silver").select("city", "day")
    assert incremental.repair_pairs(lake, pairs) == 2
    assert _all(lake) == want
    assert incremental.repair_pairs(lake, pairs.where("false")) == 0


def test_states_of_zones_null_readings_and_ties(spark, tmp_path):
    """Half-hour zones, values whose sums are not exact in binary, and nulls, in any order of batches."""
    lake = _lake(spark, tmp_path, tz="Asia/Kolkata")
    msgs = [msg("A", f"2026-06-25T{h:02d}:{m:02d}", t=0.1 * (h + m)) for h in (0, 1, 23) for m in (0, 29, 30, 59)]
    for part in (msgs[8:], msgs[:3], msgs[2:9], msgs[:1]):
        _load(spark, lake, *part)
    rows = lake.read("silver").limit(1).select(
        F.lit("N").alias("city"), "event_time", F.lit(None).cast("double").alias("temperature_c"), "humidity_pct",
        "wind_speed_kmh", "weather_code", "condition", "ingested_at", "day")
    incremental.write_silver(lake, rows)
    incremental.refresh_gold(lake, rows)
    got = _equals_rebuild(lake)
    none = [r for r in got["daily"] if r[0] == "N"]
    assert len(none) == 1 and none[0][1:5] == (None, None, None, 0)
    from aurum.operators import gold
    want = gold.build_daily(lake.read("silver"), lake.cfg).select(*lake.schema("daily").names).collect()
    assert sorted(map(tuple, want), key=repr) == got["daily"]
    want = gold.build_hourly(lake.read("silver"), lake.cfg).select(*lake.schema("hourly").names).collect()
    assert sorted(map(tuple, want), key=repr) == got["hourly"]


def _day_rows(spark, lake, per_city, cities=40):
    """A day's first twenty hours, ``per_city`` readings a key."""
    step = 20 * 3600 // per_city
    i = F.col("id")
    return spark.range(0, cities * per_city, 1, 4).select(
        F.concat(F.lit("k"), i % cities).alias("city"),
        F.timestamp_seconds(F.lit(int(dt.datetime(2026, 6, 25, tzinfo=dt.timezone.utc).timestamp()))
                            + F.floor(i / cities) * step).alias("event_time"),
        (i % 37 + 0.25).cast("double").alias("temperature_c"), F.lit(40).alias("humidity_pct"),
        F.lit(1.0).alias("wind_speed_kmh"), F.lit(0).alias("weather_code"), F.lit("Clear").alias("condition"),
        F.current_timestamp().alias("ingested_at"), F.lit(DAY).alias("day"))


def _bytes_read(spark):
    stats = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(stats.get(k).getBytesRead() for k in range(stats.size()))


def test_bytes_read_do_not_grow_with_the_day(spark, tmp_path):
    """A micro-batch into a day of 4,000 and of 400,000 stored readings, on time and late."""
    read = {}
    for per_city in (100, 10_000):
        lake = _lake(spark, f"{tmp_path}/{per_city}")
        rows = _day_rows(spark, lake, per_city)
        assert incremental.write_silver(lake, rows) == 40 * per_city
        incremental.refresh_gold(lake, rows)
        stored = sum(s.stat().st_size for s in (tmp_path / f"{per_city}/lake/silver").rglob("*.parquet"))
        on_time = [msg(f"k{k}", f"2026-06-25T22:{m:02d}") for k in range(20) for m in (1, 2, 3)]
        late = [msg(f"k{k}", f"2026-06-25T05:{m:02d}:05", t=50.0) for k in range(20) for m in (1, 2)]
        for name, batch in (("on time", on_time), ("late", late)):
            start = _bytes_read(spark)
            assert _load(spark, lake, *batch) == len(batch)
            read[per_city, name] = _bytes_read(spark) - start
        read[per_city, "stored"] = stored
        if per_city == 100:
            _equals_rebuild(lake)
    assert read[10_000, "stored"] > 10 * read[100, "stored"]
    assert read[10_000, "on time"] < 1.1 * read[100, "on time"], read
    # late rows are compared with the pages of silver's keys that hold their times
    assert read[10_000, "late"] - read[100, "late"] < read[10_000, "stored"] / 5, read


def test_many_days_are_read_as_one_range(spark, tmp_path):
    lake = _lake(spark, tmp_path)
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    batch = [msg("A", f"{d}T{h:02d}:00", t=float(h)) for d in days for h in (1, 5)]
    assert _load(spark, lake, *batch) == 80
    assert _load(spark, lake, *batch, msg("A", "2026-01-01T03:00", t=4.0)) == 1
    _equals_rebuild(lake)


def test_retention_drops_states(spark, tmp_path):
    lake = _lake(spark, tmp_path)
    _load(spark, lake, *FIRST)
    lake.drop_days_before("silver", DAY)
    assert {r["day"] for r in lake.read("partials").collect()} == {DAY}
    assert _load(spark, lake, *SECOND) == 1  # A 04:40; C is late
    assert lake.read("late").count() == 1 and lake.read("daily").where("city = 'C'").isEmpty()


def test_scale_of_the_mean_is_bounded(spark, tmp_path):
    lake = _lake(spark, tmp_path, mean_scale=13)
    with pytest.raises(ValueError, match="mean_scale"):
        _load(spark, lake, *FIRST)
