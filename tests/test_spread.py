"""Rows are dealt over tasks by the size of the input, whatever its row groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from aurum import session
from aurum.functions import parse
from aurum.operators import incremental, silver
from aurum.plans import registry
from aurum.sources.store import MedallionStore
from aurum.sources import events as ev


def _events(spark, path, n):
    """One file of one row group."""
    rows = spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_micros(F.col("id") * 1_000_000).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"), F.rand(1).alias("value"),
        F.lit('{"k": 20}').alias("props"))
    rows.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def _rows_by_task(df):
    return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_a_row_group_of_many_splits_is_spread(spark, tmp_path):
    events = _events(spark, str(tmp_path / "one row group"), 20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert events.rdd.getNumPartitions() > 10
        assert len(_rows_by_task(events)) == 1  # all rows in one of the splits
        rows = _rows_by_task(ev.events_as_messages(events))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(rows) == 20_000 and len(rows) == 4 and max(rows) < 6_000


def test_tasks_follow_the_size(spark, tmp_path, monkeypatch):
    events = _events(spark, str(tmp_path / "sized"), 20_000)
    size = session.total_size(spark, events.inputFiles())
    assert size == sum(p.stat().st_size for p in (tmp_path / "sized").glob("part-*"))
    monkeypatch.setattr(ev, "TASK_BYTES", size // 20 + 1)
    rows = _rows_by_task(ev.events_as_messages(events))
    assert len(rows) == 20 and max(rows) < 1_500
    assert ev.shares(spark.range(5).toDF("event_id"), 1) == 1


def test_null_and_repeated_ids_do_not_gather(spark, tmp_path):
    events = _events(spark, str(tmp_path / "nulls"), 8_000).withColumn("event_id", F.lit(None).cast("long"))
    rows = _rows_by_task(ev.spread(events))
    assert sum(rows) == 8_000 and len(rows) == 4 and max(rows) < 3_000


def test_each_value_of_a_message_is_worked_out_once(spark, tmp_path, capsys):
    typed = parse.parse_messages(ev.events_as_messages(_events(spark, str(tmp_path / "once"), 50)))
    silver.gate(typed).select("city", "event_time", "temperature_c", "humidity_pct", "wind_speed_kmh", "weather_code",
                              "condition").explain(True)
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("inf(inity)?") == 4  # one pattern for each measure: the gate and the labels add none


def test_serving_queries_parse_once(spark, tmp_path):
    _events(spark, str(tmp_path / "events.parquet"), 50)
    for name in ("kpi_row_chosen", "trend"):
        files = registry.QUERIES[name](spark, str(tmp_path)).inputFiles()
        assert files and not any("events.parquet" in f for f in files)


def test_rows_that_the_caller_keeps_stay_kept(spark, tmp_path):
    typed = parse.parse_messages(ev.events_as_messages(_events(spark, str(tmp_path / "kept"), 50)))
    lake = MedallionStore(spark, str(tmp_path / "lake")).ensure_tables()
    rows = silver.to_silver(typed).persist()
    try:
        n = incremental.write_silver(lake, rows)
        assert n == lake.read("silver").count() > 0
        assert rows.storageLevel.useMemory  # the next step reads these rows again
    finally:
        rows.unpersist()
    own = silver.to_silver(typed)
    assert incremental.write_silver(lake, own) == 0 and not own.storageLevel.useMemory
