"""Arrival order of landing messages: positions, and which copy stays."""

from __future__ import annotations

import gzip
import json
import os
import time

import pytest
from conftest import msg
from pyspark.sql import functions as F

from aurum.functions import parse
from aurum.operators import silver
from aurum.sources import streams
from aurum.sources.store import MedallionStore
from aurum.streaming import medallion


def _put(folder, name, lines, minutes_ago=0, zipped=False):
    os.makedirs(folder, exist_ok=True)
    with (gzip.open(f"{folder}/{name}", "wt") if zipped else open(f"{folder}/{name}", "w")) as f:
        f.write("".join(x + "\n" for x in lines))
    then = time.time() - 60 * minutes_ago
    os.utime(f"{folder}/{name}", (then, then))


@pytest.mark.parametrize("block", [700, 4096, 128 << 20])
def test_positions_grow_along_each_file(spark, tmp_path, block):
    """Files of many blocks, of one, an empty one, empty lines and a compressed file, which is never cut."""
    folder = f"{tmp_path}/in"
    for i, n in enumerate((2000, 3, 40, 0, 170)):
        _put(folder, f"f{i}.json", [json.dumps({"file": i, "line": k, "pad": "x" * (k * 7 % 30)}) for k in range(n)])
    _put(folder, "z.json.gz", [json.dumps({"file": 9, "line": k}) for k in range(500)], zipped=True)
    _put(folder, "short.txt", [str(k) if k % 3 else "" for k in range(3000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        rows = streams.read_landing_batch(spark, folder)
        if block == 700:
            assert rows.rdd.getNumPartitions() > 50
        rows = rows.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 2000 + 3 + 40 + 170 + 500 + 3000
    assert all(r["src_offset"] is not None and r["src_time"] is not None for r in rows)
    by_file = {}
    for r in sorted(rows, key=lambda r: (r["source"], r["src_offset"])):
        by_file.setdefault(os.path.basename(r["source"]), []).append((r["src_offset"], r["value"]))
    for name, got in by_file.items():
        offsets = [o for o, _ in got]
        assert all(a < b for a, b in zip(offsets, offsets[1:])), name
        if name == "short.txt":
            assert [v for _, v in got] == [str(k) if k % 3 else "" for k in range(3000)]
        else:
            assert [json.loads(v)["line"] for _, v in got] == list(range(len(got)))


def _copies(first, last):
    return [msg("A", t=first), msg("B", t=7.0), msg("A", t=last)]


def test_copies_resolve_by_delivery(spark, tmp_path):
    """Within a file the last line counts, over files the newest file, whatever its name."""
    folder = f"{tmp_path}/in"
    _put(folder, "b.json", _copies(50.0, 20.0), minutes_ago=5)
    _put(folder, "a.json", _copies(40.0, 1.0), minutes_ago=3)
    _put(folder, "c.json", _copies(30.0, 59.0), minutes_ago=9)
    got = silver.to_silver(parse.parse_messages(streams.read_landing_batch(spark, folder))).collect()
    assert {r["city"]: r["temperature_c"] for r in got} == {"A": 1.0, "B": 7.0}
    for form in ("stream", "tiers"):
        lake, source = MedallionStore(spark, f"{tmp_path}/{form}").ensure_tables(), streams.read_landing(spark, folder)
        if form == "stream":
            medallion.start_medallion(source, lake, f"{tmp_path}/cp").awaitTermination()
            log = lake.read("bronze")
        else:
            medallion.run_tiers_available_now(spark, source, lake, f"{tmp_path}/tiers-cp")
            log = spark.read.schema(medallion.BRONZE_LOG_SCHEMA).parquet(lake.path(medallion.BRONZE_LOG))
        assert {r["city"]: r["temperature_c"] for r in lake.read("silver").collect()} == {"A": 1.0, "B": 7.0}
        assert log.count() == 9 and log.where("src_offset IS NULL OR src_time IS NULL").isEmpty()
    # a later fetch still counts more than a later delivery
    _put(folder, "d.json", [msg("A", t=13.0, fetched="2026-06-25T12:32:00+05:30")], minutes_ago=60)
    got = silver.to_silver(parse.parse_messages(streams.read_landing_batch(spark, folder))).collect()
    assert {r["city"]: r["temperature_c"] for r in got}["A"] == 13.0


def test_batches_of_other_sources_keep_their_position(spark):
    topic = spark.createDataFrame([(msg("A", t=float(k)), "t:0", k) for k in range(3)],
                                  "value string, source string, src_offset bigint")
    assert streams.placed(topic) is topic
    assert silver.to_silver(parse.parse_messages(topic)).first()["temperature_c"] == 2.0
    assert silver.position(topic.columns) == ("src_offset",)
    none = topic.drop("source", "src_offset")
    assert silver.position(none.columns) == ()
    assert silver.to_silver(parse.parse_messages(none)).first()["temperature_c"] == 2.0


def test_bronze_of_an_earlier_version_is_read(spark, tmp_path):
    """Bronze rows written before files' times were kept read as null there."""
    lake = MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()
    medallion.process_batch(lake, spark.createDataFrame([(msg("A"),)], "value string"), 0)
    old = lake.read("bronze").drop("src_time").withColumn("batch_id", F.lit(1).cast("bigint"))
    old.write.mode("append").partitionBy("batch_id").parquet(lake.path("bronze"))
    assert [r["src_time"] for r in lake.read("bronze").collect()] == [None, None]


def test_run_log_of_the_tiers(spark, tmp_path):
    """Every message, bad one, insert and refresh is in the log, also of a replay and beside older rows."""
    folder, lake = f"{tmp_path}/in", MedallionStore(spark, f"{tmp_path}/lake").ensure_tables()
    old = [f.name for f in lake.schema("runlog").fields if f.name not in ("tier", "lag_s")]
    medallion.log_run(lake, {"batch_id": 0, "messages_in": 1, "malformed": 0, "silver_rows": 1, "silver_inserted": 1})
    one = lake.read("runlog").select(*old).collect()
    spark.createDataFrame([r.asDict() for r in one], lake.read("runlog").select(*old).schema).write.mode(
        "append").parquet(lake.path("runlog"))
    _put(folder, "a.json", [msg("A"), "no json", msg("B"), msg("A")])
    medallion.run_tiers_available_now(spark, streams.read_landing(spark, folder), lake, f"{tmp_path}/cp")
    _put(folder, "b.json", [msg("A"), msg("C", "2026-06-24T10:00"), "[]", "{"])
    medallion.run_tiers_available_now(spark, streams.read_landing(spark, folder), lake, f"{tmp_path}/cp")
    log = {(r["tier"], r["batch_id"]): r for r in lake.run_log().collect()}
    got = {k: (r["messages_in"], r["malformed"], r["silver_rows"], r["silver_inserted"], r["touched_days"])
           for k, r in log.items()}
    assert got == {("medallion", 0): (1, 0, 1, 2, None),
                   ("silver", 0): (4, 1, 2, 2, 1), ("silver", 1): (4, 2, 2, 1, 2),
                   ("gold", 0): (None, None, 2, None, 1), ("gold", 1): (None, None, 1, None, 1)}
    assert all(r["lag_s"] >= 0 for k, r in log.items() if k[0] != "medallion")
    assert lake.run_gaps().isEmpty()
    medallion.log_run(lake, {"tier": "gold", "batch_id": 5})
    assert [tuple(r) for r in lake.run_gaps().collect()] == [("gold", 1, 3)]
