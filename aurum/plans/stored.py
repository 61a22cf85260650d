"""Queries over stored tables: life cycle of bronze, bounded backfill, added columns,
clustered days, typed reads and serving from a store.

Each one writes its tables below a fresh folder of the session's scratch root, from
all of ``events``, and returns what is read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import session
from ..config import DEFAULT
from ..operators import backfill, incremental, silver
from ..sources import events as ev
from ..sources import streams
from ..sources.store import MedallionStore
from ..streaming import medallion
from . import serve
from .jobs import DAILY_OUT, SILVER_OUT, _silver_sql, _wb, new_lake
from .registry import ORACLES, _max_event_time, cut_sql, cut_ts, register
from .tables import Tables, silver_from_events, typed_events


def _batches(spark, sf_dir, n: int) -> list:
    """Messages of ``events`` in ``n`` equal spans of time."""
    events = ev.read_table(spark, sf_dir, "events")
    cuts = [None, *[cut_ts(events, i, n) for i in range(1, n)], None]
    out = []
    for lo, hi in zip(cuts, cuts[1:]):
        part = events
        if lo is not None:
            part = part.where(F.col("ts") >= lo)
        if hi is not None:
            part = part.where(F.col("ts") < hi)
        out.append(ev.events_as_messages(part))
    return out


@register("bronze_life_cycle", f"""
SELECT 'merged' AS part, 3::BIGINT AS batches, count(*) AS messages, count(*) AS places FROM events
UNION ALL SELECT 'kept', 1, count(*), count(*) FROM events WHERE ts >= {cut_sql(2, 3)}""")
def q_bronze_life_cycle(spark, sf_dir):
    """T2 + T14: three batches of three days are merged but for the newest, which is then
    delivered again; retention drops the first two days."""
    lake = new_lake(spark, "bronze")
    parts = _batches(spark, sf_dir, 3)
    for i, part in enumerate(parts):
        rows = medallion.bronze_rows(part).withColumn("batch_id", F.lit(i).cast("bigint"))
        (rows.withColumn("slice", F.lit(f"2026-01-0{i + 1}.b{i}")).write.mode("append").partitionBy("slice")
         .parquet(lake.path("bronze")))
    lake.merge_bronze()
    medallion.write_bronze(lake, parts[2], 2)

    def counts(part):
        return lake.read("bronze").agg(
            F.lit(part).alias("part"), F.count_distinct("batch_id").alias("batches"), F.count(F.lit(1)).alias("messages"),
            F.count_distinct("src_offset").alias("places")).collect()  # one row

    out = counts("merged")
    lake.drop_days_before("bronze", "2026-01-03")
    return spark.createDataFrame([*out, *counts("kept")])


@register("backfill_ranges", _wb("SELECT * FROM daily"))
def q_backfill_ranges(spark, sf_dir):
    """X2 + X6: one batch of the whole month in ranges of a week; the first call ends after
    two of them, the second one goes on."""
    lake = new_lake(spark, "backfill")
    rows = silver_from_events(spark, sf_dir)
    backfill.run(lake, rows, "month", days=7, most=2)
    backfill.run(lake, rows, "month")
    return lake.read("daily").select(*DAILY_OUT)


@register("column_added", _wb(f"""
, a AS ({_silver_sql(f"fetched_at < {cut_sql(1, 2)}")})
SELECT city, event_time, temperature_c, day, 'no' AS checked FROM a
UNION ALL
SELECT city, event_time, temperature_c, day, 'yes' FROM silver s
WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.city = s.city AND a.event_time = s.event_time)"""))
def q_column_added(spark, sf_dir):
    """T13 + T7: a column is added to silver between two batches; rows stored before it
    have its default, later ones what they were written with."""
    lake = new_lake(spark, "column")
    typed = typed_events(spark, sf_dir)
    cut = cut_ts(ev.read_table(spark, sf_dir, "events"), 1, 2)
    incremental.write_silver(lake, silver.to_silver(typed.where(F.col("ts") < cut)))
    lake.add_column("silver", "checked", "STRING", "'no'")
    incremental.write_silver(lake, silver.to_silver(typed).withColumn("checked", F.lit("yes")))
    return lake.read("silver").select("city", "event_time", "temperature_c", "day", "checked")


@register("batch_load_typed", _wb("""
SELECT day, count(*) AS readings, count(*) AS stamped, 0::BIGINT AS before,
       CAST(sum(humidity_pct) AS BIGINT) AS humidity FROM silver GROUP BY day"""))
def q_batch_load_typed(spark, sf_dir):
    """A store that is not there reads as empty; messages in
    the connector's shape (BINARY value, topic, partition, offset) are loaded in one
    batch; set-up runs twice; silver's columns come back with their types and stamp."""
    lake = MedallionStore(spark, session.fresh_dir(spark, "load"), DEFAULT)
    before = lake.read("silver").count()
    lake.ensure_tables().ensure_tables()
    raw = ev.events_as_messages(ev.read_table(spark, sf_dir, "events")).select(
        F.col("value").cast("binary").alias("value"), F.lit("readings").alias("topic"),
        F.pmod(F.xxhash64("key"), F.lit(8)).cast("int").alias("partition"), F.col("src_offset").alias("offset"))
    medallion.process_batch(lake, streams.connector_rows(raw), 0)
    return lake.read("silver").groupBy("day").agg(
        F.count(F.lit(1)).alias("readings"), F.count("ingested_at").alias("stamped"),
        F.lit(before).cast("bigint").alias("before"), F.sum("humidity_pct").alias("humidity"))


def _served(spark, sf_dir) -> MedallionStore:
    """A filled store, its silver days clustered by key."""
    lake = new_lake(spark, "served")
    rows = silver_from_events(spark, sf_dir).persist()
    try:
        summary = incremental.batch_summary(rows, lake.cfg)
        incremental.write_silver(lake, rows, summary)
        incremental.refresh_gold(lake, rows, None, summary)
    finally:
        rows.unpersist()
    lake.compact("silver", summary["days"], by="key")
    return lake


@register("keys_on_day", _wb("SELECT DISTINCT city FROM silver WHERE day = (SELECT max(day) FROM silver)"))
def q_keys_on_day(spark, sf_dir):
    """The keys of the newest stored day, whose folder alone is read."""
    lake = new_lake(spark, "keys")
    incremental.write_silver(lake, silver_from_events(spark, sf_dir))
    day = max(n[4:] for n in session.child_names(spark, lake.path("silver")) if n.startswith("day="))
    return lake.keys_on_day(day)


@register("stored_spotlight", ORACLES["spotlight"])
def q_stored_spotlight(spark, sf_dir):
    """V10 + F5 over stored tables whose days are clustered by key."""
    t = Tables.from_store(_served(spark, sf_dir))
    return serve.spotlight(t, serve.hottest_key(t))


@register("stored_trend", ORACLES["trend"])
def q_stored_trend(spark, sf_dir):
    """V11 + F7 over stored tables: the trailing window prunes days."""
    t = Tables.from_store(_served(spark, sf_dir))
    return serve.trend(t, 12, None, as_of=_max_event_time(t))


@register("stored_kpi_row", ORACLES["kpi_row"])
def q_stored_kpi_row(spark, sf_dir):
    """V7 + A4-A6, A9 over stored gold: no reading is parsed or aggregated again."""
    return serve.kpi_row(Tables.from_store(_served(spark, sf_dir)))


@register("stored_silver", _wb(f"SELECT {', '.join(SILVER_OUT)} FROM silver"))
def q_stored_silver(spark, sf_dir):
    """P14 + T14: silver after clustering, row by row with its types."""
    return _served(spark, sf_dir).read("silver").select(*SILVER_OUT)
