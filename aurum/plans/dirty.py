"""The whole ``events`` table as dirty messages, through parsing, gate, keep-last and a batch.

Each event becomes one message; its id decides what is wrong with it (one in sixteen
is clean).  The oracle's text is written out by hand: labels, bounds, shapes and
offsets are its own, not taken from ``rules`` or ``Config``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse
from ..operators import silver
from ..sources import events as ev
from ..sources.store import MedallionStore
from ..streaming import medallion
from .registry import register


def dirty_messages(spark, sf_dir) -> DataFrame:
    """events -> (src_offset, value), every kind of fault by id."""
    e = ev.spread(ev.read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "props"))
    kind, k = F.col("event_id") % 16, ev.props_k(F.col("props"))
    is_ = lambda *n: kind.isin(*n)
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    slot, number = ev.slot_text(F.col("ts")), F.col("value").cast("string")
    city = F.when(is_(12), F.lit("null")).otherwise(q(F.col("user_id").cast("string")))
    time = (F.when(is_(7), q(F.concat(slot, F.lit("+05:30")))).when(is_(8), q(F.concat(slot, F.lit(":00Z"))))
            .when(is_(14), q(F.date_format("ts", "dd/MM/yyyy HH:mm")))
            .when(is_(6), q(F.concat(F.lit("  "), F.regexp_replace(slot, "T", " "), F.lit(" ")))).otherwise(q(slot)))
    temp = (F.when(is_(3), q(F.concat(F.lit(" "), number, F.lit(" ")))).when(is_(4), q(F.lit("NaN")))
            .when(is_(5), q(F.lit("-Infinity"))).when(is_(11), q(F.concat(number, F.lit("d")))).otherwise(number))
    humidity = F.when(is_(10), F.lit("50.5")).otherwise((k + 10).cast("string"))
    wind = F.when(is_(15), F.lit("null")).otherwise((k - 5).cast("string"))
    code = (F.when(is_(9), F.concat(k.cast("string"), F.lit(".5"))).when(is_(10), q(F.lit("1e400")))
            .otherwise(k.cast("string")))
    fetched = (F.when(is_(6), F.lit("null")).when(is_(9, 10, 7), q(F.date_format("ts", "yyyy-MM-dd'T'00:00:00")))
               .otherwise(q(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))))
    parts = [("city", city), ("event_time", time), ("temperature_c", temp), ("humidity_pct", humidity),
             ("wind_speed_kmh", wind), ("weather_code", code), ("fetched_at", fetched)]
    text = F.concat(F.lit("{"), *[x for i, (name, v) in enumerate(parts)
                                  for x in (F.lit(("," if i else "") + f'"{name}":'), v)], F.lit("}"))
    value = (F.when(is_(0), F.expr("substr(text, 1, length(text) - 4)")).when(is_(1), F.concat(F.lit("["), "text", F.lit("]")))
             .when(is_(2), F.lit(None).cast("string")).when(is_(13), F.concat("text", F.lit(" {}")))
             .otherwise(F.col("text")))
    return e.withColumn("text", text).select(F.col("event_id").alias("src_offset"), value.alias("value"))


# The same faults said once more, as SQL, from the events themselves.
_SQL = """
WITH raw AS (
  SELECT event_id, event_id % 16 AS kind, user_id, ts, value, time_bucket(INTERVAL '15 minutes', ts) AS slot,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
read AS (
  SELECT event_id AS src_offset,
         CASE WHEN kind <> 12 THEN CAST(user_id AS VARCHAR) END AS city,
         CASE WHEN kind = 14 THEN NULL WHEN kind = 7 THEN slot - INTERVAL '330 minutes' ELSE slot END AS event_time,
         CASE WHEN kind IN (4, 11) THEN NULL WHEN kind = 5 THEN '-Infinity'::DOUBLE ELSE value END AS temperature_c,
         CASE WHEN kind = 10 THEN 50.5 ELSE k + 10 END::DOUBLE AS humidity_pct,
         CASE WHEN kind <> 15 THEN k - 5 END::DOUBLE AS wind_speed_kmh,
         CASE WHEN kind = 9 THEN k + 0.5 WHEN kind = 10 THEN 'Infinity'::DOUBLE ELSE k END::DOUBLE AS weather_code,
         CASE WHEN kind = 10 THEN NULL ELSE k END AS whole_code,
         CASE WHEN kind = 6 THEN NULL WHEN kind IN (7, 9, 10) THEN date_trunc('day', ts) ELSE ts END AS fetched
  FROM raw WHERE kind NOT IN (0, 1, 2, 13)),
typed AS (
  SELECT * EXCLUDE (whole_code),
         CASE WHEN whole_code = 0 THEN 'Clear' WHEN whole_code IN (1, 2, 3) THEN 'Cloudy'
              WHEN whole_code IN (45, 48) THEN 'Fog' WHEN whole_code IN (51, 53, 55, 56, 57) THEN 'Drizzle'
              WHEN whole_code IN (61, 63, 65, 66, 67) THEN 'Rain' WHEN whole_code IN (71, 73, 75, 77) THEN 'Snow'
              WHEN whole_code IN (80, 81, 82) THEN 'Rain showers' WHEN whole_code IN (85, 86) THEN 'Snow showers'
              WHEN whole_code IN (95, 96, 99) THEN 'Thunderstorm' ELSE 'Unknown' END AS condition
  FROM read),
judged AS (
  SELECT *, CASE WHEN city IS NULL OR event_time IS NULL THEN 'missing_key'
                 WHEN temperature_c IS NULL OR temperature_c < -60 OR temperature_c > 60 THEN 'temperature'
                 WHEN humidity_pct < 0 OR humidity_pct > 100 THEN 'humidity'
                 WHEN wind_speed_kmh IS NULL OR wind_speed_kmh < 0 THEN 'wind' END AS reason
  FROM typed),
kept AS (
  SELECT * FROM judged WHERE reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY city, event_time
    ORDER BY fetched IS NULL DESC, fetched DESC, src_offset DESC) = 1)
"""

_VALUES = ["city", "event_time", "temperature_c", "humidity_pct", "wind_speed_kmh", "weather_code", "condition"]


@register("dirty_typed", _SQL + f"""
SELECT src_offset, {', '.join(_VALUES)}, fetched AS fetched_ts FROM typed""")
def q_dirty_typed(spark, sf_dir):
    """Quoted, padded, infinite, non-numeric and fractional numbers, offsets, other
    date forms, null keys; messages that are cut, lists, null or followed by text go."""
    typed = parse.parse_messages(dirty_messages(spark, sf_dir))
    return typed.select("src_offset", *_VALUES, "fetched_ts")


@register("dirty_rejects", _SQL + """
SELECT coalesce(reason, 'valid') AS reason, count(*) AS messages, sum(src_offset)::BIGINT AS offsets FROM judged GROUP BY ALL
UNION ALL SELECT 'malformed', count(*), sum(event_id)::BIGINT FROM raw WHERE kind IN (0, 1, 2, 13)""")
def q_dirty_rejects(spark, sf_dir):
    """What becomes of every dirty message, with the sum of the positions."""
    decoded = parse.decode_json(dirty_messages(spark, sf_dir))
    typed = parse.type_message(decoded)
    each = [decoded.where("is_malformed").select(F.lit("malformed").alias("reason"), "src_offset"),
            silver.rejects(typed).select("reason", "src_offset"),
            silver.gate(typed).select(F.lit("valid").alias("reason"), "src_offset")]
    return (each[0].unionByName(each[1]).unionByName(each[2]).groupBy("reason")
            .agg(F.count(F.lit(1)).alias("messages"), F.sum("src_offset").alias("offsets")))


_SILVER = """SELECT city, event_time, temperature_c,
         floor(humidity_pct + 0.5)::INTEGER AS humidity_pct, wind_speed_kmh,
         CASE WHEN isfinite(weather_code) THEN floor(weather_code + 0.5)::INTEGER END AS weather_code,
         condition, event_time::DATE AS day FROM kept"""


@register("dirty_silver", _SQL + _SILVER)
def q_dirty_silver(spark, sf_dir):
    """Of copies the one without a fetch time stays, then the latest fetch, then the
    latest position; whole numbers round half up, infinite ones are null."""
    rows = silver.to_silver(parse.parse_messages(dirty_messages(spark, sf_dir)))
    return rows.select(*_VALUES, "day")


@register("dirty_batch", _SQL + """
SELECT 'log' AS part, (SELECT count(*) FROM events) AS a, (SELECT count(*) FROM raw WHERE kind IN (0, 1, 2, 13)) AS b,
       (SELECT count(*) FROM kept) AS c
UNION ALL SELECT 'empty', 0, 0, 0
UNION ALL SELECT 'again', (SELECT count(*) FROM events), (SELECT count(*) FROM raw WHERE kind IN (0, 1, 2, 13)), 0
UNION ALL SELECT 'bronze', (SELECT count(*) FROM events), (SELECT count(*) FROM raw WHERE kind IN (0, 1, 2, 13)),
       (SELECT count(*) FROM raw WHERE kind = 2)
UNION ALL SELECT 'daily', count(*), count(DISTINCT city), (SELECT count(*) FROM kept)
  FROM (SELECT DISTINCT city, event_time::DATE AS day FROM kept)""")
def q_dirty_batch(spark, sf_dir):
    """A dirty batch, an empty one and the first one again through all
    layers: counts (a, b, c) of the runs, of bronze (all, malformed, null) and of gold
    (rows, keys, readings)."""
    from .jobs import new_lake
    lake: MedallionStore = new_lake(spark, "dirty")
    batch = dirty_messages(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)  # read and made once
    try:
        runs = [("log", medallion.process_batch(lake, batch, 0)),
                ("empty", medallion.process_batch(lake, batch.where(F.col("src_offset").isNull()), 1)),
                ("again", medallion.process_batch(lake, batch, 0))]
    finally:
        batch.unpersist()
    out = spark.createDataFrame([(n, r["messages_in"], r["malformed"], r["silver_inserted"]) for n, r in runs],
                                "part string, a bigint, b bigint, c bigint")
    bronze = lake.read("bronze").agg(F.lit("bronze").alias("part"), F.count(F.lit(1)).alias("a"),
                                     F.count_if("is_malformed").alias("b"), F.count_if(F.col("raw_json").isNull()).alias("c"))
    daily = lake.read("daily").agg(F.lit("daily").alias("part"), F.count(F.lit(1)).alias("a"),
                                   F.countDistinct("city").alias("b"), F.sum("readings").alias("c"))
    return out.unionByName(bronze).unionByName(daily)
