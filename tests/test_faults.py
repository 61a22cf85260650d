"""Faults found in review: lost input, overwritten tables, wrong buckets."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from conftest import msg
from pyspark.sql import functions as F

from aurum.config import Config
from aurum.functions import parse, times
from aurum.operators import gold, incremental, lookups, silver
from aurum.sources import streams
from aurum.sources.store import MedallionStore
from aurum.streaming import medallion


def _drain(spark, landing, lake, checkpoint):
    q = medallion.start_medallion(streams.read_landing(spark, landing), lake, checkpoint)
    q.awaitTermination()
    assert not q.exception()


def _land(landing, name, *messages, days_back=0):
    os.makedirs(landing, exist_ok=True)
    path = f"{landing}/{name}.json"
    with open(path, "w") as f:
        f.write("\n".join(messages) + "\n")
    then = time.time() - days_back * 86400
    os.utime(path, (then, then))


def test_old_dated_file_is_read(spark, tmp_path):
    landing, lake = f"{tmp_path}/in", MedallionStore(spark, f"{tmp_path}/lake")
    _land(landing, "a", msg("A"))
    _drain(spark, landing, lake, f"{tmp_path}/cp")
    _land(landing, "b", msg("B"), days_back=30)
    _drain(spark, landing, lake, f"{tmp_path}/cp")
    assert {r["city"] for r in lake.read("latest").collect()} == {"A", "B"}
    assert lake.read("bronze").count() == 2


def test_new_checkpoint_refused_after_an_empty_first_batch(spark, tmp_path):
    landing, lake = f"{tmp_path}/in", MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()
    rows = spark.createDataFrame([(msg("A"),)], "value string")
    medallion.process_batch(lake, rows.where("false"), 0)
    medallion.process_batch(lake, rows, 1)  # the only folder is batch_id=1
    _land(landing, "b", msg("B"))
    with pytest.raises(RuntimeError, match="already holds data"):
        medallion.start_medallion(streams.read_landing(spark, landing), lake, f"{tmp_path}/other")
    assert lake.read("bronze").count() == 1


def test_bucket_count_and_zone_are_fixed_by_the_store(spark, tmp_path):
    lake = MedallionStore(spark, f"{tmp_path}/lake", Config(latest_buckets=4)).ensure_tables()
    typed = parse.parse_messages(spark.createDataFrame([(msg(f"c{i}"),) for i in range(20)], "value string"))
    rows = silver.to_silver(typed, lake.cfg)
    incremental.write_silver(lake, rows)
    incremental.refresh_gold(lake, rows)
    wider = MedallionStore(spark, lake.root, Config(latest_buckets=16))
    with pytest.raises(ValueError, match="latest_buckets"):
        incremental.refresh_gold(wider, rows)
    with pytest.raises(ValueError, match="tz"):
        MedallionStore(spark, lake.root, Config(latest_buckets=4, tz="Asia/Kolkata")).ensure_tables()
    wider.rebucket()
    incremental.refresh_gold(wider, rows)
    assert wider.read("latest").count() == wider.read("latest").select("city").distinct().count() == 20
    assert wider.read("latest").where(F.col("bucket") != gold.latest_bucket(F.col("city"), wider.cfg)).isEmpty()


def test_late_row_below_retention_leaves_gold(spark, tmp_path):
    lake = MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()

    def load(*messages):
        df = spark.createDataFrame([(m,) for m in messages], "value string")
        medallion.process_batch(lake, df, load.n)
        load.n += 1

    load.n = 0
    load(*[msg("A", f"2026-06-01T{h:02d}:30", t=20.0 + h) for h in range(10)], msg("A", "2026-06-03T12:30"))
    before = sorted(map(tuple, lake.read("daily").collect()), key=str)
    lake.drop_days_before("silver", dt.date(2026, 6, 2))
    load(msg("A", "2026-06-01T11:30", t=5.0))
    assert sorted(map(tuple, lake.read("daily").collect()), key=str) == before
    assert lake.read("late").count() == 1
    log = {r["batch_id"]: r for r in lake.run_log().collect()}
    assert log[0]["silver_inserted"] == 11 and log[1]["silver_inserted"] == 0


def test_replayed_batch_is_one_run_log_row(spark, tmp_path):
    lake = MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()
    df = spark.createDataFrame([(msg("A"),)], "value string")
    for _ in range(2):
        medallion.process_batch(lake, df, 7)
    assert [(r["batch_id"], r["silver_inserted"]) for r in lake.run_log().collect()] == [(7, 1)]


def test_copies_without_position_resolve_alike(spark):
    copies = [msg("A", t=20.0), msg("A", t=30.0)]
    out = set()
    for order in (copies, copies[::-1]):
        df = spark.createDataFrame([(m, None) for m in order], "value string, src_offset bigint")
        out.add(silver.to_silver(parse.parse_messages(df)).first()["temperature_c"])
    assert len(out) == 1


def test_hours_of_a_clock_change_stay_apart(spark):
    rows = [("2024-11-03T05:30:00Z",), ("2024-11-03T06:30:00Z",), ("2024-11-03T07:10:00Z",)]
    df = spark.createDataFrame(rows, "s string").select(F.col("s").cast("timestamp").alias("ts"))
    got = [r[0] for r in df.select(F.date_format(times.hour_bucket(F.col("ts"), "America/New_York"), "HH:mm")).collect()]
    assert got == ["05:00", "06:00", "07:00"]
    half = df.select(F.date_format(times.hour_bucket(F.col("ts"), "Asia/Kolkata"), "HH:mm")).collect()
    assert [r[0] for r in half] == ["05:30", "06:30", "06:30"]


def test_store_pins_the_session_clock(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        MedallionStore(spark, f"{tmp_path}/lake")
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_api_payload_is_parsed_once_and_as_strictly_as_messages(spark):
    good = '{"current": {"time": "2026-06-25T12:30", "temperature_2m": 20.5}}'
    rows = [("A", good, "x"), ("B", good + " tail", "x"), ("C", good.replace('"', "'"), "x"), ("D", None, "x")]
    flat = parse.flatten_api_payload(spark.createDataFrame(rows, "city string, payload string, fetched_at string"))
    assert [r["value"] for r in flat.collect()] and flat.count() == 1
    assert flat._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_chosen_keys_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(c, 1) for c in "abc"], "city string, v int").write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    plan = lookups.key_filter(t, ["a", "unknown"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(city" in plan
    assert lookups.key_filter(t, ["unknown"]).count() == 3


def test_batch_reads_only_the_touched_days(spark, tmp_path):
    from aurum.operators.merge import read_partitions
    lake = MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()
    df = spark.createDataFrame([(msg("A", f"2026-06-{d:02d}T12:30"),) for d in range(1, 21)], "value string")
    incremental.write_silver(lake, silver.to_silver(parse.parse_messages(df)))
    got = read_partitions(spark, lake.path("silver"), lake.schema("silver"), "day", [dt.date(2026, 6, 3)])
    assert len(got.inputFiles()) == 1 and got.count() == 1
    assert got.first()["day"] == dt.date(2026, 6, 3)
