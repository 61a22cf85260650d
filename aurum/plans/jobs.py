"""Write-path queries: keyed merges, incremental gold, streaming, retention.

Each one writes real tables below a fresh folder of the session's shared
scratch root (``spark.checkpoint.dir``), then returns a read of the result.
Batches are cut from the events time span (never by id), so every query runs
over the whole table.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import session
from ..config import DEFAULT
from ..operators import gold, incremental, merge, silver
from ..schemas import HOURLY_SCHEMA
from ..sources import events as ev
from ..sources import streams
from ..sources.store import MedallionStore
from ..streaming import medallion, windowed
from .registry import cut_sql, cut_ts, register
from .tables import typed_events

SILVER_OUT = ["city", "event_time", "temperature_c", "humidity_pct", "wind_speed_kmh",
              "weather_code", "condition", "day"]


def new_lake(spark: SparkSession, name: str) -> MedallionStore:
    return MedallionStore(spark, session.fresh_dir(spark, name), DEFAULT).ensure_tables()


DAILY_OUT = ["city", "day", "avg_temp", "max_temp", "min_temp", "readings", "heatwave"]


def _silver_sql(where: str) -> str:
    return f"""
  SELECT city, event_time, temperature_c, CAST(humidity_pct AS INTEGER) AS humidity_pct,
         wind_speed_kmh, CAST(weather_code AS INTEGER) AS weather_code, condition,
         CAST(event_time AS DATE) AS day
  FROM valid WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY city, event_time
                             ORDER BY fetched_at DESC, src_offset DESC) = 1"""


def _daily_sql(rel: str) -> str:
    from .oracle import AVG
    return f"""
  SELECT city, day, {AVG} AS avg_temp, max(temperature_c) AS max_temp,
         min(temperature_c) AS min_temp, CAST(count(temperature_c) AS INTEGER) AS readings,
         max(temperature_c) > {DEFAULT.heatwave_threshold} AS heatwave
  FROM {rel} GROUP BY city, day"""


def _latest_sql(rel: str) -> str:
    return f"""
  SELECT city, event_time, temperature_c, humidity_pct, condition FROM {rel}
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY event_time DESC) = 1"""


def _wb(body: str) -> str:
    from .oracle import with_base
    return with_base(body)


# ---------------------------------------------------------------- T7 / J4
@register("insert_if_absent", _wb(f"""
, a AS ({_silver_sql(f"fetched_at < {cut_sql(1, 2)}")})
SELECT * FROM a
UNION ALL
SELECT * FROM silver s
WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.city = s.city AND a.event_time = s.event_time)"""))
def q_insert_if_absent(spark, sf_dir):
    """T7 + J4: load the first half, then replay everything; the first write
    of a key wins across batches."""
    lake = new_lake(spark, "insert-if-absent")
    typed = typed_events(spark, sf_dir).drop("key", "value").persist(StorageLevel.MEMORY_AND_DISK)  # parsed once
    try:
        cut = cut_ts(ev.read_table(spark, sf_dir, "events"), 1, 2)
        incremental.write_silver(lake, silver.to_silver(typed.where(F.col("ts") < cut)))
        incremental.write_silver(lake, silver.to_silver(typed))
    finally:
        typed.unpersist()
    return lake.read("silver").select(*SILVER_OUT)


# ---------------------------------------------------------------- T9, T10 / J5
@register("upsert_replace", _wb(f"""
, sa AS ({_silver_sql(f"fetched_at < {cut_sql(1, 2)}")}),
sb AS ({_silver_sql(f"fetched_at >= {cut_sql(1, 2)}")}),
da AS ({_daily_sql('sa')}),
db AS ({_daily_sql('sb')})
SELECT * FROM da WHERE NOT EXISTS (
  SELECT 1 FROM db WHERE db.city = da.city AND db.day = da.day)
UNION ALL SELECT * FROM db"""))
def q_upsert_replace(spark, sf_dir):
    """T9/T10 + J5: daily buckets of a second batch replace the stored ones."""
    lake = new_lake(spark, "upsert-replace")
    typed = typed_events(spark, sf_dir)
    cut = cut_ts(ev.read_table(spark, sf_dir, "events"), 1, 2)
    for part in (typed.where(F.col("ts") < cut), typed.where(F.col("ts") >= cut)):
        merge.merge_keyed(spark, lake.path("daily"), gold.build_daily(silver.to_silver(part)),
                          ["city", "day"], "day", "replace", lake.schema("daily"))
    return lake.read("daily").select("city", "day", "avg_temp", "max_temp", "min_temp",
                                     "readings", "heatwave")


# ---------------------------------------------------------------- T8 / J6
@register("upsert_if_newer", _wb(f"""
, sa AS ({_silver_sql(f"fetched_at < {cut_sql(1, 2)}")}),
sm AS ({_silver_sql(f"fetched_at >= {cut_sql(1, 4)}")}),
la AS ({_latest_sql('sa')}),
lu AS ({_latest_sql('sm')}),
keep AS (
  SELECT lu.* FROM lu LEFT JOIN la ON lu.city = la.city
  WHERE la.city IS NULL OR lu.event_time > la.event_time)
SELECT * FROM la WHERE city NOT IN (SELECT city FROM keep)
UNION ALL SELECT * FROM keep"""))
def q_upsert_if_newer(spark, sf_dir):
    """T8 + J6: latest per key moves forward only (strictly newer wins)."""
    lake = new_lake(spark, "upsert-if-newer")
    typed = typed_events(spark, sf_dir)
    events = ev.read_table(spark, sf_dir, "events")
    ts = F.col("ts")
    first = typed.where(ts < cut_ts(events, 1, 2))
    second = typed.where(ts >= cut_ts(events, 1, 4))  # overlaps the first batch
    for part in (first, second):
        upd = gold.with_latest_bucket(gold.build_latest(silver.to_silver(part)))
        merge.merge_keyed(spark, lake.path("latest"), upd, ["city"], "bucket",
                          "replace_if_newer", lake.schema("latest"), time_col="event_time")
    return lake.read("latest").select(*gold.LATEST_COLS)


# ---------------------------------------------------------------- X2 (+ X6)
def _day_batches(spark, sf_dir):
    """Typed messages cut into three whole-day ranges, newest first, so that
    the later batches are late data for the gold tables."""
    typed = typed_events(spark, sf_dir)
    events = ev.read_table(spark, sf_dir, "events")
    d1 = F.to_date(cut_ts(events, 1, 3))
    d2 = F.to_date(cut_ts(events, 2, 3))
    day = F.to_date(F.col("ts"))
    return [typed.where(day >= d2), typed.where((day >= d1) & (day < d2)),
            typed.where(day < d1)]


def _incremental_lake(spark, sf_dir) -> MedallionStore:
    lake = new_lake(spark, "incremental")
    for batch in _day_batches(spark, sf_dir):
        sb = silver.to_silver(batch).persist()
        try:
            summary = incremental.batch_summary(sb, lake.cfg)
            incremental.write_silver(lake, sb, summary)
            incremental.refresh_gold(lake, sb, None, summary)
        finally:
            sb.unpersist()
    return lake


@register("incremental_gold", _wb("SELECT * FROM daily"))
def q_incremental_gold(spark, sf_dir):
    """X2 + T9/T10 + X6: three day-range batches, newest first; incremental
    daily gold equals the one-shot roll-up."""
    lake = _incremental_lake(spark, sf_dir)
    return lake.read("daily").select(*DAILY_OUT)


@register("incremental_latest_hourly", _wb("""
SELECT h.city, h.hour_start, h.avg_temp, h.readings, l.event_time AS latest_time
FROM hourly h JOIN latest l ON h.city = l.city"""))
def q_incremental_latest_hourly(spark, sf_dir):
    """X2 + T8/T9: incremental hourly and latest tables (late batches must not
    move latest back)."""
    lake = _incremental_lake(spark, sf_dir)
    lat = lake.read("latest").select("city", F.col("event_time").alias("latest_time"))
    return (lake.read("hourly").select("city", "hour_start", "avg_temp", "readings")
            .join(lat, "city"))


@register("repair_pairs", _wb("SELECT * FROM daily"))
def q_repair_pairs(spark, sf_dir):
    """R4 + J3: gold that never saw its silver rows is recomputed for the pairs
    silver has, from all rows of these pairs."""
    lake = new_lake(spark, "repair")
    incremental.write_silver(lake, silver.to_silver(typed_events(spark, sf_dir)))
    incremental.repair_pairs(lake, lake.read("silver").select("city", "day"))
    return lake.read("daily").select(*DAILY_OUT)


# ---------------------------------------------------------------- streaming
def _land_batches(spark, sf_dir, landing: str, replay_first: bool = True) -> int:
    """Write the events as JSON-line messages into ``landing``, one folder per
    whole-day range plus a re-delivery of the first range.  Copies of a
    (key, slot) share a file, as a keyed topic keeps a key in one partition.
    Each range gets files by the input's size (at least 2), so the write stays
    parallel on a large input; returns that file count."""
    events = ev.read_table(spark, sf_dir, "events")
    files = max(2, ev.shares(events, ev.FILE_BYTES))
    rows = ev.dealt(events).persist(StorageLevel.MEMORY_AND_DISK)  # read once for all ranges
    msgs = ev.messages_of(rows).withColumn("slot", ev.slot_text(F.col("ts")))
    d1 = F.to_date(cut_ts(events, 1, 3))
    d2 = F.to_date(cut_ts(events, 2, 3))
    day = F.to_date(F.col("ts"))
    parts = [msgs.where(day < d1), msgs.where((day >= d1) & (day < d2)), msgs.where(day >= d2)]
    if replay_first:
        parts.append(parts[0])
    try:
        for i, part in enumerate(parts):
            streams.write_messages(part, f"{landing}/part{i}", files, ["key", "slot"])
    finally:
        rows.unpersist()
    return files


def _landing_stream(spark, landing: str, files_per_part: int = 2):
    """Two day ranges per micro-batch."""
    return streams.read_landing(spark, landing, 2 * files_per_part)


def run_stream_medallion(spark, sf_dir, name: str = "stream"):
    """Land the events as messages, drain the one-query medallion with
    availableNow; returns (store, finished query)."""
    root = session.fresh_dir(spark, name)
    landing = f"{root}/landing"
    files = _land_batches(spark, sf_dir, landing)
    lake = MedallionStore(spark, f"{root}/lake", DEFAULT)
    q = medallion.start_medallion(_landing_stream(spark, landing, files), lake,
                                  f"{root}/checkpoint")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return lake, q


def _streamed(spark, sf_dir) -> MedallionStore:
    """The store that a stream fills from this input, anew on each call."""
    return run_stream_medallion(spark, sf_dir)[0]


@register("stream_medallion", _wb("SELECT * FROM daily"))
def q_stream_medallion(spark, sf_dir):
    """X1 + T2 + T4 + X7: landing-directory stream, foreachBatch medallion,
    availableNow; the first day range is delivered twice."""
    return _streamed(spark, sf_dir).read("daily").select(*DAILY_OUT)


@register("stream_bronze_counts", f"""
SELECT false AS is_malformed,
       count(*) + count(*) FILTER (WHERE CAST(ts AS DATE) < CAST({cut_sql(1, 3)} AS DATE))
         AS messages
FROM events""")
def q_stream_bronze_counts(spark, sf_dir):
    """Bronze keeps every delivered message (re-deliveries too)."""
    return (_streamed(spark, sf_dir).read("bronze").groupBy("is_malformed")
            .agg(F.count(F.lit(1)).alias("messages")))


@register("stream_run_log", _wb(f"""
SELECT (SELECT count(*) + count(*) FILTER (WHERE CAST(ts AS DATE) < CAST({cut_sql(1, 3)} AS DATE))
        FROM events)::BIGINT AS messages_in, 0::BIGINT AS malformed,
       (SELECT count(*) FROM silver)::BIGINT AS silver_inserted"""))
def q_stream_run_log(spark, sf_dir):
    """A10: the run log accounts for every message and every inserted row."""
    return _streamed(spark, sf_dir).run_log().agg(
        *[F.sum(c).alias(c) for c in ("messages_in", "malformed", "silver_inserted")])


@register("stream_late_files", _wb("SELECT * FROM daily"))
def q_stream_late_files(spark, sf_dir):
    """Files that carry an old date, placed after newer ones were read
    (a backfill that keeps modification times), reach all layers."""
    root = session.fresh_dir(spark, "stream-late")
    landing = f"{root}/landing"
    events = ev.read_table(spark, sf_dir, "events")
    files = max(2, ev.shares(events, ev.FILE_BYTES))
    rows = ev.dealt(events).persist(StorageLevel.MEMORY_AND_DISK)  # read once for both
    msgs = ev.messages_of(rows).withColumn("slot", ev.slot_text(F.col("ts")))
    cut = F.to_date(cut_ts(events, 1, 2))
    lake = MedallionStore(spark, f"{root}/lake", DEFAULT)
    try:
        for name, part in (("new", F.to_date("ts") >= cut), ("old", F.to_date("ts") < cut)):
            streams.write_messages(msgs.where(part), f"{landing}/{name}", files, ["key", "slot"])
            if name == "old":
                session.set_age(spark, f"{landing}/{name}", days=30)
            q = medallion.start_medallion(streams.read_landing(spark, landing, 2 * files), lake,
                                          f"{root}/checkpoint")
            q.awaitTermination()
            if q.exception():
                raise q.exception()
    finally:
        rows.unpersist()
    return lake.read("daily").select(*DAILY_OUT)


def _tiered(spark, sf_dir) -> MedallionStore:
    """The store that the three chained queries fill from this input."""
    root = session.fresh_dir(spark, "tiers")
    landing = f"{root}/landing"
    files = _land_batches(spark, sf_dir, landing)
    lake = MedallionStore(spark, f"{root}/lake", DEFAULT).ensure_tables()
    medallion.run_tiers_available_now(spark, _landing_stream(spark, landing, files), lake,
                                      f"{root}/checkpoint")
    return lake


@register("stream_tiers", _wb("SELECT * FROM daily"))
def q_stream_tiers(spark, sf_dir):
    """Three chained queries (bronze log, silver, gold), each with its
    own checkpoint, drained with availableNow."""
    return _tiered(spark, sf_dir).read("daily").select(*DAILY_OUT)


@register("stream_tiers_run_log", _wb(f"""
SELECT 'silver' AS tier, (SELECT count(*) + count(*) FILTER (WHERE CAST(ts AS DATE) < CAST({cut_sql(1, 3)} AS DATE))
        FROM events)::BIGINT AS messages_in, 0::BIGINT AS malformed,
       (SELECT count(*) FROM silver)::BIGINT AS silver_inserted, NULL::BIGINT AS silver_read,
       0::BIGINT AS gaps, true AS has_lag
UNION ALL SELECT 'gold', NULL, NULL, NULL, (SELECT count(*) FROM silver)::BIGINT, 0, true"""))
def q_stream_tiers_run_log(spark, sf_dir):
    """A10 on the timer path: the tiers' log accounts for every message, every row put into
    silver and every silver row gold has seen; no batch is missing and each has its lag."""
    log, gaps = (lake := _tiered(spark, sf_dir)).run_log(), lake.run_gaps()
    gold_only = lambda c: F.sum(F.when(F.col("tier") == "gold", F.col(c)))
    total = log.groupBy("tier").agg(
        F.sum("messages_in").alias("messages_in"), F.sum("malformed").alias("malformed"),
        F.sum("silver_inserted").alias("silver_inserted"), gold_only("silver_rows").alias("silver_read"),
        F.bool_and(F.col("lag_s") >= 0).alias("has_lag"))
    missing = gaps.groupBy("tier").agg(F.sum("missing").alias("gaps"))
    return (total.join(missing, "tier", "left").fillna(0, ["gaps"])
            .select("tier", "messages_in", "malformed", "silver_inserted", "silver_read", "gaps", "has_lag"))


_FORMS = ("batch", "stream", "tiers")


@register("stream_arrival_order", _wb(f"""
, last AS (
  SELECT * EXCLUDE (fetched_at) FROM valid
  QUALIFY row_number() OVER (PARTITION BY city, event_time ORDER BY src_offset DESC) = 1)
SELECT form, city, event_time, temperature_c, CAST(humidity_pct AS INTEGER) AS humidity_pct, condition
FROM last, (VALUES {", ".join(f"('{f}')" for f in _FORMS)}) AS f(form)
UNION ALL
SELECT form || ' without position', NULL, NULL, NULL, NULL, NULL
FROM (VALUES {", ".join(f"('{f}')" for f in _FORMS)}) AS f(form) WHERE false"""))
def q_stream_arrival_order(spark, sf_dir):
    """O7 + W1: every message says it was fetched at the start of its day, so copies of
    a reading tie and the one delivered last is kept: by a batch read of the landing
    files, by the one-query stream and by the three tiers.  Copies share a file, in
    the order of their ids.  A message without a position would be a row of its own."""
    root = session.fresh_dir(spark, "arrival")
    events = ev.read_table(spark, sf_dir, "events")
    msgs = ev.events_as_messages(events).withColumn("slot", ev.slot_text(F.col("ts")))
    day = F.date_format("ts", "yyyy-MM-dd'T'00:00:00")
    tied = F.regexp_replace("value", F.lit('"fetched_at":"[^"]*"'), F.concat(F.lit('"fetched_at":"'), day, F.lit('"')))
    files = max(2, ev.shares(events, ev.FILE_BYTES))
    (msgs.withColumn("value", tied).repartition(files, "key", "slot").sortWithinPartitions("src_offset")
     .select("value").write.text(f"{root}/in"))
    source = lambda: streams.read_landing(spark, f"{root}/in", 2 * files)
    lakes = {f: MedallionStore(spark, f"{root}/{f}", DEFAULT).ensure_tables() for f in _FORMS}
    batch = streams.read_landing_batch(spark, f"{root}/in")
    medallion.process_batch(lakes["batch"], batch, 0)
    q = medallion.start_medallion(source(), lakes["stream"], f"{root}/checkpoint")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    medallion.run_tiers_available_now(spark, source(), lakes["tiers"], f"{root}/tiers-checkpoint")
    out = None
    for form, lake in lakes.items():
        cols = ["city", "event_time", "temperature_c", "humidity_pct", "condition"]
        log = (spark.read.schema(medallion.BRONZE_LOG_SCHEMA).parquet(lake.path(medallion.BRONZE_LOG))
               if form == "tiers" else lake.read("bronze"))
        lost = (log.where("src_offset IS NULL OR src_time IS NULL")
                .select(F.lit(f"{form} without position").alias("form"),
                        *[F.lit(None).cast(lake.schema("silver")[c].dataType).alias(c) for c in cols]))
        part = lake.read("silver").select(F.lit(form).alias("form"), *cols).unionByName(lost)
        out = part if out is None else out.unionByName(part)
    return out


def run_stream_windowed(spark, sf_dir, replay: bool = False):
    """Land the events by day ranges in order, drain the watermark form; returns
    (path of the closed hours, finished query).  A last message two days ahead closes all
    hours but its own.  ``replay`` delivers the first range again, too late."""
    root = session.fresh_dir(spark, "windowed")
    landing, out = f"{root}/landing", f"{root}/hours"
    events = ev.read_table(spark, sf_dir, "events")
    files = _land_batches(spark, sf_dir, landing, replay_first=replay)
    ahead = events.agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts")).select(
        F.lit(0).cast("long").alias("event_id"), "ts", F.lit(0).cast("long").alias("user_id"),
        F.lit("x").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 50}').alias("props"))
    end = ev.events_as_messages(ahead)
    # one range a micro-batch, in order: a batch drops what is behind the batch before it
    for i in range(4 if replay else 3):
        start = windowed.start_windowed_hourly
        part = streams.read_landing_batch(spark, f"{landing}/part{i}")
        streams.write_messages(part.withColumn("key", F.xxhash64("value")), f"{root}/in", files, ["key"])
        q = start(streams.read_landing(spark, f"{root}/in", files), out, f"{root}/checkpoint")
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    streams.write_messages(end.withColumn("key", F.lit(0)), f"{root}/in", 1, ["key"])
    q = windowed.start_windowed_hourly(streams.read_landing(spark, f"{root}/in", files), out, f"{root}/checkpoint")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return out, q


@register("stream_windowed", _wb("SELECT city, hour_start, avg_temp, max_temp, min_temp, readings FROM hourly"))
def q_stream_windowed(spark, sf_dir):
    """2.10: two chained stateful aggregations behind a watermark, last copy per
    (key, time), then the hour; equals the refresh when no row is late."""
    out, _ = run_stream_windowed(spark, sf_dir)
    return (spark.read.schema(HOURLY_SCHEMA).parquet(out)
            .select("city", "hour_start", "avg_temp", "max_temp", "min_temp", "readings"))


# ---------------------------------------------------------------- T12, T14
@register("rebuild_gold", _wb("SELECT * FROM daily"))
def q_rebuild_gold(spark, sf_dir):
    """Gold rebuilt from a stored silver table."""
    lake = new_lake(spark, "rebuild")
    incremental.write_silver(lake, silver.to_silver(typed_events(spark, sf_dir)))
    incremental.rebuild_gold(lake)
    return lake.read("daily").select("city", "day", "avg_temp", "max_temp", "min_temp",
                                     "readings", "heatwave")


@register("retention", _wb(f"""
SELECT city, event_time, temperature_c, humidity_pct, wind_speed_kmh, weather_code,
       condition, day FROM silver WHERE day >= CAST({cut_sql(1, 2)} AS DATE)"""))
def q_retention(spark, sf_dir):
    """Silver day partitions older than the cut day are dropped."""
    lake = new_lake(spark, "retention")
    incremental.write_silver(lake, silver.to_silver(typed_events(spark, sf_dir)))
    events = ev.read_table(spark, sf_dir, "events")
    cut_day = spark.range(1).select(F.to_date(cut_ts(events, 1, 2))).first()[0]
    lake.drop_days_before("silver", cut_day)
    return lake.read("silver").select(*SILVER_OUT)


@register("retention_late", _wb(f"""
SELECT 'gold' AS part, city, day, avg_temp, readings FROM daily
UNION ALL
SELECT 'late', city, day, NULL, CAST(count(*) AS INTEGER) FROM silver
WHERE day < CAST({cut_sql(1, 2)} AS DATE) GROUP BY city, day"""))
def q_retention_late(spark, sf_dir):
    """T14 + X6: after retention, everything is delivered again.  Gold keeps the
    dropped days as they were; their rows are set aside."""
    lake = new_lake(spark, "retention-late")
    rows = silver.to_silver(typed_events(spark, sf_dir)).persist()
    try:
        summary = incremental.batch_summary(rows, lake.cfg)
        incremental.write_silver(lake, rows, summary)
        incremental.refresh_gold(lake, rows, None, summary)
        events = ev.read_table(spark, sf_dir, "events")
        lake.drop_days_before("silver", spark.range(1).select(F.to_date(cut_ts(events, 1, 2))).first()[0])
        incremental.write_silver(lake, rows, summary)
        incremental.refresh_gold(lake, rows, None, summary)
    finally:
        rows.unpersist()
    gold_rows = lake.read("daily").select(F.lit("gold").alias("part"), "city", "day", "avg_temp", "readings")
    late = (lake.read("late").groupBy("city", "day").agg(F.count(F.lit(1)).cast("int").alias("readings"))
            .select(F.lit("late").alias("part"), "city", "day", F.lit(None).cast("double").alias("avg_temp"),
                    "readings"))
    return gold_rows.unionByName(late)
