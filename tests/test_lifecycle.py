"""Bronze's life cycle, bounded backfills, added columns, clustered days."""

from __future__ import annotations

import datetime as dt

import pyarrow.parquet as pq
import pytest
from conftest import messages_df, msg
from pyspark.sql import functions as F
from test_partials import _all, _day_rows, _equals_rebuild, _lake

from aurum.config import Config
from aurum.functions import parse
from aurum.operators import backfill, incremental, silver
from aurum.sources import versioned
from aurum.sources.store import MedallionStore
from aurum.streaming import medallion


class Killed(Exception):
    pass


def _killed(*a, **k):
    raise Killed


def _write(lake, batch_id, day, *values, name=None):
    """A batch as written on some day."""
    rows = medallion.bronze_rows(messages_df(lake.spark, list(values)))
    (rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).withColumn("slice", F.lit(f"{day}.b{batch_id}"))
     .write.mode("append").partitionBy("slice").parquet(lake.path("bronze")))


def _bronze(lake):
    return sorted((r["batch_id"], r["src_offset"], r["raw_json"]) for r in lake.read("bronze").collect())


def _folders(tmp_path):
    return sorted(p.name for p in (tmp_path / "lake/bronze").iterdir() if p.is_dir())


# ------------------------------------------------------------------ bronze
def test_closed_days_are_merged_into_few_files(spark, tmp_path, monkeypatch):
    lake = MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()
    for b in range(12):
        _write(lake, b, f"2026-06-{25 + b // 5}", msg("A", t=float(b)), msg("B"))
    want = _bronze(lake)
    assert len(want) == 24
    assert lake.merge_bronze() == 11  # all but the newest
    assert _bronze(lake) == want
    merged = sorted((tmp_path / "lake/bronze.v").glob("ver=*/slice=*/*.parquet"))
    assert {p.parent.name for p in merged} == {"slice=2026-06-25.m4", "slice=2026-06-26.m9", "slice=2026-06-27.m10"}
    assert len(merged) == 3  # one file a day, whatever the batches
    # nothing more to merge while the newest batch is alone
    assert lake.merge_bronze() == 0
    # merged folders go when readers are done, and rows never count twice
    monkeypatch.setattr(versioned, "KEEP_S", 0)
    _write(lake, 12, "2026-06-28", msg("C"))
    assert lake.merge_bronze() == 1
    assert _folders(tmp_path) == ["slice=2026-06-27.b11", "slice=2026-06-28.b12"]
    _write(lake, 13, "2026-06-29", msg("D"))
    assert lake.merge_bronze() == 1
    assert _folders(tmp_path) == ["slice=2026-06-28.b12", "slice=2026-06-29.b13"]
    assert len(_bronze(lake)) == 26 and len(lake.table("bronze").state()[1]["parts"]) < 8
    assert lake.drop_days_before("bronze", dt.date(2026, 6, 27))
    assert {r[0] for r in _bronze(lake)} == {10, 11, 12, 13}


def test_replay_of_a_batch_on_the_next_day(spark, tmp_path):
    """The second delivery goes where the first one is."""
    lake = MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()
    _write(lake, 0, "2026-06-24", msg("A"))
    _write(lake, 1, "2026-06-25", msg("A"), msg("B"))
    want = _bronze(lake)
    medallion.write_bronze(lake, messages_df(spark, [msg("A"), msg("B")]), 1)
    assert _bronze(lake) == want
    assert lake.bronze_slice(1) == "2026-06-25.b1"
    assert lake.bronze_slice(2, dt.date(2026, 6, 26)) == "2026-06-26.b2"
    # batch 0 lay in a day that had ended
    assert set(lake.table("bronze").state()[1]["parts"]) == {"slice=2026-06-24.b0", "slice=2026-06-24.m0"}


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    lake = MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()
    for b in range(3):
        _write(lake, b, "2026-06-25", msg("A", t=float(b)))
    want = _bronze(lake)
    with monkeypatch.context() as m:
        m.setattr(versioned.NumberedFile, "publish", _killed)
        with pytest.raises(Killed):
            lake.merge_bronze(force=True)
    assert _bronze(lake) == want
    assert lake.merge_bronze(force=True) == 2 and _bronze(lake) == want


def test_open_batches_of_a_day_are_bounded(spark, tmp_path):
    lake = MedallionStore(spark, f"{tmp_path}/lake", Config(bronze_open_batches=3)).ensure_tables()
    for b in range(9):
        medallion.write_bronze(lake, messages_df(spark, [msg("A", t=float(b))]), b)
        known = lake.table("bronze").state()[1]["parts"]
        assert len([f for f in _folders(tmp_path) if f not in known]) <= 3
    assert [r[0] for r in _bronze(lake)] == list(range(9))


def test_folders_of_an_earlier_version_are_adopted(spark, tmp_path):
    lake = MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()
    rows = medallion.bronze_rows(messages_df(spark, [msg("A"), msg("B")]))
    for b in (3, 10):
        (rows.withColumn("batch_id", F.lit(b).cast("bigint")).write.mode("append").partitionBy("batch_id")
         .parquet(lake.path("bronze")))
    want = _bronze(lake)
    assert [r[0] for r in want] == [3, 3, 10, 10]
    assert lake.adopt_bronze() == 2 and lake.adopt_bronze() == 0
    assert _bronze(lake) == want
    assert lake.merge_bronze(force=True) == 1 and _bronze(lake) == want


# ---------------------------------------------------------------- backfill
def _many_days(spark, lake, days, first=dt.date(2020, 1, 1)):
    """Two keys with one reading a day."""
    i = F.col("id")
    day = F.date_add(F.lit(first), F.floor(i / 2).cast("int"))
    return spark.range(0, 2 * days, 1, 4).select(
        F.concat(F.lit("k"), i % 2).alias("city"), day.cast("timestamp").alias("event_time"),
        (i % 50).cast("double").alias("temperature_c"), F.lit(40).alias("humidity_pct"),
        F.lit(1.0).alias("wind_speed_kmh"), F.lit(0).alias("weather_code"), F.lit("Clear").alias("condition"),
        F.current_timestamp().alias("ingested_at"), day.alias("day"))


def test_backfill_goes_on_after_a_death(spark, tmp_path, monkeypatch):
    """A batch of very many days: each step sees the days of one range, done ranges are not done again."""
    lake = _lake(spark, tmp_path)
    rows, seen = _many_days(spark, lake, 90), []
    plain = incremental.refresh_gold

    def spy(lake_, part, only=None, summary=None):
        seen.append(len(summary["days"]))
        if len(seen) == 3:
            raise Killed
        return plain(lake_, part, only, summary)

    monkeypatch.setattr(incremental, "refresh_gold", spy)
    with pytest.raises(Killed):
        backfill.run(lake, rows, "job", days=25)
    assert lake.read("daily").count() == 2 * sum(seen[:2])
    out = backfill.run(lake, rows, "job", days=7)  # goes on with the ranges it began with
    assert out["left"] == 0 and out["done"] == len(seen) - 1
    assert max(seen) <= 25 and sum(seen) - seen[2] == 90
    assert lake.read("silver").count() == 180 and lake.read("daily").count() == 180
    _equals_rebuild(lake)
    n = len(seen)
    assert backfill.run(lake, rows.limit(0), "job") == out and len(seen) == n
    assert backfill.forget(lake, "jo") == ["job"] and backfill.forget(lake, "jo") == []


def test_a_micro_batch_of_many_days_is_worked_off_in_ranges(spark, tmp_path, monkeypatch):
    lake = MedallionStore(spark, f"{tmp_path}/lake", Config(max_touched_days=3)).ensure_tables()
    monkeypatch.setattr(backfill.run, "__defaults__", (2, *backfill.run.__defaults__[1:]))
    days = [dt.date(2026, 6, 1) + dt.timedelta(days=i) for i in range(4)]
    batch = messages_df(spark, [msg(c, f"{d}T10:00", t=20.0) for d in days for c in "AB"])
    row = medallion.process_batch(lake, batch, 4)
    assert (row["silver_inserted"], row["touched_days"]) == (8, 4)
    want = _equals_rebuild(lake)
    assert medallion.process_batch(lake, batch, 4)["touched_days"] == 4 and _all(lake) == want
    medallion.process_batch(lake, messages_df(spark, [msg("C", f"{d}T11:00") for d in days]), 5)
    assert lake.read("silver").count() == 12
    assert [p.name for p in (tmp_path / "lake/backfill").iterdir() if p.is_dir()] == ["batch-5"]
    _equals_rebuild(lake)


def test_backfill_of_nothing_and_of_extra_columns(spark, tmp_path):
    lake = _lake(spark, tmp_path)
    rows = _many_days(spark, lake, 3)
    assert backfill.run(lake, rows.limit(0), "none") == {"done": 0, "left": 0, "inserted": 0}
    assert backfill.run(lake, rows.withColumn("range", F.lit(99)).withColumn("x", F.lit(1)), "more")["inserted"] == 6


# ----------------------------------------------------------- added columns
def test_added_columns_of_stored_tables(spark, tmp_path):
    lake = _lake(spark, tmp_path)
    rows = _many_days(spark, lake, 2)
    incremental.write_silver(lake, rows)
    incremental.refresh_gold(lake, rows)
    other = _lake(spark, tmp_path)
    assert other.read("silver").count() == 4
    assert lake.add_column("silver", "station", "STRING", "'none'")
    assert not lake.add_column("silver", "station", "STRING", "'none'")
    assert lake.add_column("daily", "rank", "INT", "7") and lake.add_column("silver", "note", "DOUBLE")
    assert {(r["station"], r["note"]) for r in lake.read("silver").collect()} == {("none", None)}
    assert lake.read("silver").where("station = 'none'").count() == 4
    assert lake.read("silver").where("station is null").isEmpty()
    # another handle writes with the columns from its next batch on, an explicit null stays
    more = _many_days(spark, lake, 3, dt.date(2021, 1, 1)).withColumn(
        "station", F.when(F.col("city") == "k0", "s"))
    assert incremental.write_silver(other, more) == 6
    incremental.refresh_gold(other, more)
    got = {(r["city"], r["station"]): r["n"] for r in other.read("silver").where("year(day) = 2021")
           .groupBy("city", "station").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("k0", "s"): 3, ("k1", None): 3}
    assert {r["rank"] for r in other.read("daily").collect()} == {7} and other.read("daily").count() == 10
    lake.compact("silver", [dt.date(2020, 1, 1)])
    incremental.rebuild_gold(lake)
    assert lake.read("silver").where("station = 'none'").count() == 4
    assert {r["rank"] for r in lake.read("daily").collect()} == {7}
    with pytest.raises(ValueError, match="columns can be added"):
        lake.add_column("partials", "x", "INT")
    with pytest.raises(Exception):
        lake.add_column("silver", "bad", "INT", "'x'")
    assert "bad" not in lake.read("silver").columns


def test_streams_write_added_columns(spark, tmp_path):
    lake = MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()
    medallion.process_batch(lake, messages_df(spark, [msg("A")]), 0)
    lake.add_column("silver", "station", "STRING", "'none'")
    lake.drop_days_before("silver", "2026-06-25")
    medallion.process_batch(lake, messages_df(spark, [msg("B"), msg("C", "2026-06-24T10:00")]), 1)
    assert [r["station"] for r in lake.read("silver").collect()] == ["none", "none"]
    assert [r["station"] for r in lake.read("late").collect()] == ["none"]


# ----------------------------------------------------------- clustered days
def test_a_key_of_a_clustered_day_opens_a_small_part(spark, tmp_path):
    lake = _lake(spark, tmp_path)
    rows = _day_rows(spark, lake, 200, cities=500).withColumn("temperature_c", F.rand(7))
    day = dt.date(2026, 6, 25)
    with spark_conf(spark, "parquet.block.size", str(128 << 10)):
        assert incremental.write_silver(lake, rows) == 100_000
        want = {tuple(r) for r in lake.read("silver").where("city = 'k77'").collect()}
        hit, groups = _row_groups(tmp_path / "lake/silver", "k77")
        assert hit == groups >= 4  # by time, each one may hold the key
        lake.compact("silver", [day], by="key")
    hit, groups = _row_groups(tmp_path / "lake/silver.v", "k77")
    assert groups >= 4 and hit <= 2, (hit, groups)
    got = lake.read("silver").where("city = 'k77'").collect()
    assert {tuple(r) for r in got} == want and len(got) == 200
    late = _day_rows(spark, lake, 1, cities=5).withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 7 SECONDS"))
    assert incremental.write_silver(lake, late) == 5 and incremental.write_silver(lake, late) == 0
    with pytest.raises(ValueError):
        lake.compact("silver", [day], by="size")


def _row_groups(folder, key):
    """Row groups whose range of cities has ``key``, and all."""
    metas = [pq.ParquetFile(p).metadata for p in folder.rglob("*.parquet")]
    groups = [m.row_group(i) for m in metas for i in range(m.num_row_groups)]
    city = [next(c for c in map(g.column, range(g.num_columns)) if c.path_in_schema == "city").statistics for g in groups]
    return sum(s.min <= key <= s.max for s in city), len(groups)


class spark_conf:
    def __init__(self, spark, key, value):
        self.conf, self.key, self.value = spark.sparkContext._jsc.hadoopConfiguration(), key, value

    def __enter__(self):
        self.conf.set(self.key, self.value)

    def __exit__(self, *a):
        self.conf.unset(self.key)


def test_connector_rows_are_parsed(spark, tmp_path):
    """BINARY values and a position per partition; a null value (a tombstone) is malformed."""
    from aurum.sources import streams
    raw = spark.createDataFrame([(bytearray(msg("A").encode()), "t", 3, 9), (None, "t", 3, 10)],
                                "value binary, topic string, partition int, offset bigint")
    got = streams.connector_rows(raw).collect()
    assert (got[0]["value"], got[0]["source"], got[0]["src_offset"]) == (msg("A"), "t:3", 9)
    lake = MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()
    row = medallion.process_batch(lake, streams.connector_rows(raw), 0)
    assert (row["messages_in"], row["malformed"], row["silver_inserted"]) == (2, 1, 1)
    assert silver.to_silver(parse.parse_messages(streams.connector_rows(raw))).count() == 1
