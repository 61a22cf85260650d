"""Registered queries over the driver's tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables.  TIMESTAMP results are returned as TIMESTAMP_NTZ (UTC wall
clock) to compare with DuckDB's TIMESTAMP.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from .. import session
from ..config import DEFAULT
from ..functions import rules, times
from ..operators import checks, gold, lookups, silver
from ..sources import events as ev
from . import serve
from .oracle import AVG, emoji_values_sql, with_base
from .tables import Tables, silver_from_events, tables_from_events, typed_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.prepare(spark)
            return comparable(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


def comparable(df: DataFrame) -> DataFrame:
    """Instants -> UTC wall clock (TIMESTAMP_NTZ)."""
    ts_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)}
    if not ts_cols:
        return df
    return df.select(*[times.to_ntz(F.col(c)).alias(c) if c in ts_cols else F.col(c)
                       for c in df.columns])


def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    return tables_from_events(spark, sf_dir, DEFAULT)


def _stored_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """For queries that use several tables or one of them twice: silver is written to
    the session's scratch root first, so each message is parsed once a query."""
    path = session.fresh_dir(spark, "serve-silver")
    rows = silver_from_events(spark, sf_dir, DEFAULT)
    rows.write.parquet(path)
    return Tables.from_silver(spark.read.schema(rows.schema).parquet(path), DEFAULT)


# ---------------------------------------------------------------- parse layer
TYPED_COLS = ["src_offset", "city", "event_time", "temperature_c", "humidity_pct",
              "wind_speed_kmh", "weather_code", "condition", "fetched_at"]


@register("parse_messages", with_base("""
SELECT src_offset, city, event_time, temperature_c, humidity_pct, wind_speed_kmh,
       weather_code, condition, strftime(fetched_at, '%Y-%m-%dT%H:%M:%S.%f') AS fetched_at
FROM typed"""))
def q_parse_messages(spark, sf_dir):
    """Events -> JSON message -> decoded typed row."""
    return typed_events(spark, sf_dir).select(*TYPED_COLS)


@register("api_payload", with_base("""
SELECT src_offset, city, event_time, temperature_c, humidity_pct, wind_speed_kmh,
       weather_code, condition, strftime(fetched_at, '%Y-%m-%dT%H:%M:%S.%f') AS fetched_at
FROM typed"""))
def q_api_payload(spark, sf_dir):
    """Landed API responses -> flat messages -> typed rows."""
    from ..functions import parse
    landed = ev.events_as_api_payloads(ev.read_table(spark, sf_dir, "events"))
    return parse.parse_messages(parse.flatten_api_payload(landed)).select(*TYPED_COLS)


@register("code_labels", with_base("""
SELECT CAST(weather_code AS INTEGER) AS weather_code, condition, count(*) AS messages
FROM typed GROUP BY ALL"""))
def q_code_labels(spark, sf_dir):
    """P5: label per code, with message counts."""
    return (typed_events(spark, sf_dir)
            .groupBy(F.col("weather_code").try_cast("int").alias("weather_code"), "condition")
            .agg(F.count(F.lit(1)).alias("messages")))


@register("validity_gate", with_base("""
SELECT src_offset, city, event_time, temperature_c, humidity_pct, wind_speed_kmh FROM valid"""))
def q_validity_gate(spark, sf_dir):
    """F1 + F2: rows that pass the key and range checks."""
    return (silver.gate(typed_events(spark, sf_dir))
            .select("src_offset", "city", "event_time", "temperature_c", "humidity_pct",
                    "wind_speed_kmh"))


@register("rejects_by_reason", with_base(f"""
SELECT CASE
         WHEN city IS NULL OR event_time IS NULL THEN 'missing_key'
         WHEN NOT coalesce(temperature_c BETWEEN {DEFAULT.temp_min} AND {DEFAULT.temp_max}, false)
           THEN 'temperature'
         WHEN NOT coalesce(humidity_pct BETWEEN {DEFAULT.humidity_min} AND {DEFAULT.humidity_max},
                           false) THEN 'humidity'
         ELSE 'wind' END AS reason,
       count(*) AS rows
FROM typed
WHERE NOT coalesce(temperature_c BETWEEN {DEFAULT.temp_min} AND {DEFAULT.temp_max}
                   AND humidity_pct BETWEEN {DEFAULT.humidity_min} AND {DEFAULT.humidity_max}
                   AND wind_speed_kmh >= {DEFAULT.wind_min}, false)
GROUP BY 1"""))
def q_rejects_by_reason(spark, sf_dir):
    """Reject output of the gate, counted by first failed check."""
    return (silver.rejects(typed_events(spark, sf_dir))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rows")))


@register("silver_clean", with_base("""
SELECT city, event_time, temperature_c, humidity_pct, wind_speed_kmh, weather_code,
       condition, day FROM silver"""))
def q_silver_clean(spark, sf_dir):
    """Gated, de-duplicated, typed silver rows."""
    return _tables(spark, sf_dir).silver.drop("ingested_at")


# ---------------------------------------------------------------- gold + serving
@register("hourly_stats", with_base("SELECT * FROM hourly"))
def q_hourly(spark, sf_dir):
    """A1, P8, P10 (V3)."""
    return serve.hourly_stats(_tables(spark, sf_dir))


@register("daily_stats", with_base("SELECT * FROM daily"))
def q_daily(spark, sf_dir):
    """A2, P9, P10 (V2)."""
    return serve.daily_stats(_tables(spark, sf_dir))


@register("city_latest", with_base("SELECT * FROM latest"))
def q_city_latest(spark, sf_dir):
    """A3 / W3 (V1)."""
    return serve.city_latest(_tables(spark, sf_dir))


@register("latest_full", with_base("SELECT * FROM latest_full"))
def q_latest_full(spark, sf_dir):
    """W2 (V5)."""
    return serve.latest_full(_tables(spark, sf_dir))


@register("heatwave_days", with_base("SELECT * FROM daily WHERE heatwave"))
def q_heatwave_days(spark, sf_dir):
    """F6 (V14)."""
    return serve.heatwave_days(_tables(spark, sf_dir))


@register("alerts", with_base(f"""
SELECT city, temperature_c, printf('%.0f', round_even(temperature_c, 0)) AS temp_label
FROM latest WHERE temperature_c > {DEFAULT.alert_threshold}"""))
def q_alerts(spark, sf_dir):
    """F3, F4, P16 (V6)."""
    return serve.alerts(_tables(spark, sf_dir))


@register("kpi_row", with_base("""
SELECT (SELECT count(*) FROM latest) AS live_keys,
       (SELECT city FROM latest WHERE temperature_c IS NOT NULL
        ORDER BY temperature_c DESC, city LIMIT 1) AS hottest_city,
       (SELECT max(temperature_c) FROM latest) AS hottest_temp,
       (SELECT city FROM latest WHERE temperature_c IS NOT NULL
        ORDER BY temperature_c ASC, city LIMIT 1) AS coolest_city,
       (SELECT min(temperature_c) FROM latest) AS coolest_temp,
       (SELECT count(*) FILTER (WHERE heatwave) FROM daily
        WHERE day = (SELECT max(day) FROM daily)) AS heatwave_keys"""))
def q_kpi_row(spark, sf_dir):
    """A4, A5, A6, A9, F8 (V7)."""
    return serve.kpi_row(_stored_tables(spark, sf_dir))


def _max_event_time(t: Tables):
    return t.silver.select(F.max("event_time")).scalar()


@register("recent_readings", with_base("""
SELECT city, event_time, temperature_c, humidity_pct, condition FROM silver
WHERE event_time >= (SELECT max(event_time) FROM silver) - INTERVAL 24 HOUR"""))
def q_recent(spark, sf_dir):
    """F7 (V4), as of the newest reading so that it is repeatable."""
    t = _stored_tables(spark, sf_dir)
    return serve.recent_readings(t, 24, as_of=_max_event_time(t))


@register("trend", with_base("""
SELECT city, event_time, temperature_c, humidity_pct, condition FROM silver
WHERE event_time >= (SELECT max(event_time) FROM silver) - INTERVAL 12 HOUR"""))
def q_trend(spark, sf_dir):
    """F7 + F4 (V11), all keys chosen."""
    t = _stored_tables(spark, sf_dir)
    return serve.trend(t, 12, None, as_of=_max_event_time(t))


@register("spotlight", with_base("""
SELECT * FROM latest_full WHERE city = (
  SELECT city FROM latest WHERE temperature_c IS NOT NULL
  ORDER BY temperature_c DESC, city LIMIT 1)"""))
def q_spotlight(spark, sf_dir):
    """F5 (V10): full latest row of the hottest key."""
    t = _stored_tables(spark, sf_dir)
    return serve.spotlight(t, serve.hottest_key(t))


@register("ranked_cards", with_base(f"""
SELECT l.city, l.temperature_c, l.condition,
       coalesce(e.emoji, '{rules.EMOJI_DEFAULT}') AS emoji,
       printf('%.1f', round_even(l.temperature_c * 10, 0) / 10) AS temp_label
FROM latest l LEFT JOIN {emoji_values_sql()} ON l.condition = e.condition"""))
def q_ranked_cards(spark, sf_dir):
    """O5 + J2 + P16 (V8)."""
    return serve.ranked_cards(_tables(spark, sf_dir))


def customer_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key -> (nation, region) through customer; nation and region have a
    fixed size (25 / 5 rows) and are broadcast, customer grows and is not."""
    cust = ev.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("city"), "c_nationkey")
    nation = ev.read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"),
        "n_regionkey")
    region = ev.read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return (cust.join(F.broadcast(nation), "c_nationkey")
                .join(F.broadcast(region), "n_regionkey")
                .select("city", "nation", "region"))


@register("map_points", with_base("""
SELECT l.city, l.temperature_c, n.n_name AS nation, r.r_name AS region
FROM latest l
JOIN customer c ON l.city = CAST(c.c_custkey AS VARCHAR)
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""))
def q_map_points(spark, sf_dir):
    """J1 (V9): inner lookup of each key's location; unmatched keys dropped."""
    return serve.map_points(_tables(spark, sf_dir), customer_locations(spark, sf_dir))


@register("daily_flag_labels", with_base(f"""
SELECT city, strftime(day, '%Y-%m-%d') AS day, max_temp,
       CASE WHEN heatwave THEN '{rules.FLAG_TRUE}' WHEN NOT heatwave THEN '{rules.FLAG_FALSE}'
       END AS flag
FROM daily"""))
def q_daily_flag_labels(spark, sf_dir):
    """P12, P13 (V12)."""
    return serve.daily_flag_labels(_tables(spark, sf_dir))


# Every hour of the month that ``events`` spans: one list for both sides.
HOUR_LABELS = [f"01-{d:02d} {h:02d}:00" for d in range(1, 32) for h in range(24)]
_PIVOT_COLS = ", ".join(f"m['{x}'] AS \"{x}\"" for x in HOUR_LABELS)


@register("hour_pivot", with_base(f"""
, cells AS (
  SELECT city, strftime(hour_start, '%m-%d %H:00') AS hour,
         CAST(SUM(CAST(avg_temp AS DECIMAL(18,2))) AS DOUBLE) / COUNT(avg_temp) AS v
  FROM hourly GROUP BY ALL),
rows AS (SELECT city, MAP(list(hour ORDER BY hour), list(v ORDER BY hour)) AS m FROM cells GROUP BY city)
SELECT city, {_PIVOT_COLS} FROM rows"""))
def q_hour_pivot(spark, sf_dir):
    """A7, P12 (V13): key x hour-label matrix; a label outside the list fails."""
    return serve.hour_pivot(_tables(spark, sf_dir), labels=HOUR_LABELS, strict=True)


# ---------------------------------------------------------------- chosen keys
# Keys a user might choose, one of them unknown; and a choice with no known key.
CHOSEN = ["1", "2", "3", "5", "8", "13", "no such key"]
UNKNOWN = ["no such key", "nor this"]


def _in(keys: list[str]) -> str:
    return "(" + ", ".join(f"'{k}'" for k in keys) + ")"


def _chosen_sql(keys: list[str]) -> str:
    return f"(city IN {_in(keys)} OR NOT EXISTS (SELECT 1 FROM latest WHERE city IN {_in(keys)}))"


@register("alerts_chosen", with_base(f"""
SELECT city, temperature_c, printf('%.0f', round_even(temperature_c, 0)) AS temp_label
FROM latest WHERE temperature_c > 40.0 AND {_chosen_sql(UNKNOWN)}"""))
def q_alerts_chosen(spark, sf_dir):
    """F3 + F4: a choice with no known key means all keys."""
    return serve.alerts(_stored_tables(spark, sf_dir), cities=UNKNOWN)


@register("trend_chosen", with_base(f"""
SELECT city, event_time, temperature_c, humidity_pct, condition FROM silver
WHERE event_time >= (SELECT max(event_time) FROM silver) - INTERVAL 240 HOUR
  AND {_chosen_sql(CHOSEN)}"""))
def q_trend_chosen(spark, sf_dir):
    """F7 + F4 (V11): chosen keys, one unknown."""
    t = _stored_tables(spark, sf_dir)
    return serve.trend(t, 240, CHOSEN, as_of=_max_event_time(t))


@register("kpi_row_chosen", with_base(f"""
, l AS (SELECT * FROM latest WHERE {_chosen_sql(CHOSEN)}),
d AS (SELECT * FROM daily WHERE {_chosen_sql(CHOSEN)})
SELECT (SELECT count(*) FROM l) AS live_keys,
       (SELECT city FROM l WHERE temperature_c IS NOT NULL
        ORDER BY temperature_c DESC, city LIMIT 1) AS hottest_city,
       (SELECT max(temperature_c) FROM l) AS hottest_temp,
       (SELECT city FROM l WHERE temperature_c IS NOT NULL
        ORDER BY temperature_c ASC, city LIMIT 1) AS coolest_city,
       (SELECT min(temperature_c) FROM l) AS coolest_temp,
       (SELECT count(*) FILTER (WHERE heatwave) FROM d
        WHERE day = (SELECT max(day) FROM daily)) AS heatwave_keys"""))
def q_kpi_row_chosen(spark, sf_dir):
    """A4-A6 + F4 (V7) for chosen keys."""
    return serve.kpi_row(_stored_tables(spark, sf_dir), CHOSEN)


@register("newest_readings", with_base("""
SELECT day, city, event_time, temperature_c, humidity_pct, wind_speed_kmh, weather_code,
       condition FROM silver ORDER BY event_time DESC, city LIMIT 20"""))
def q_newest(spark, sf_dir):
    """O6 + P15 (V15): top-k newest rows with their partition."""
    return serve.newest_readings(_tables(spark, sf_dir), 20)


@register("distinct_keys", with_base(
    "SELECT DISTINCT city FROM silver WHERE day = (SELECT max(day) FROM silver)"))
def q_distinct_keys(spark, sf_dir):
    """R6 + A8: keys seen on the newest day."""
    s = _stored_tables(spark, sf_dir).silver
    last = s.select(F.max("day")).scalar()
    return s.where(F.col("day") == last).select("city").distinct()


# Batch boundary used by the batch-shaped queries: num/den of the way through the
# events time span, in whole microseconds (same integer arithmetic in SQL).
def cut_ts(events: DataFrame, num: int, den: int):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    span = events.select(F.min(us).alias("lo"), F.max(us).alias("hi")).select(
        F.timestamp_micros(F.expr(f"lo + ((hi - lo) * {int(num)}) div {int(den)}"))
        .cast("timestamp_ntz"))
    return span.scalar()


def cut_sql(num: int, den: int) -> str:
    return (f"(SELECT make_timestamp(min(epoch_us(ts)) + "
            f"((max(epoch_us(ts)) - min(epoch_us(ts))) * {num}) // {den}) FROM events)")


@register("touched_buckets", with_base(f"""
SELECT * FROM silver s
WHERE (s.city, s.day) IN (
  SELECT DISTINCT CAST(user_id AS VARCHAR), CAST(ts AS DATE) FROM events
  WHERE ts >= {cut_sql(3, 4)})"""))
def q_touched_buckets(spark, sf_dir):
    """R4 + J3: every silver row of the (key, day) pairs a late batch touched."""
    events = ev.read_table(spark, sf_dir, "events")
    batch = (events.where(F.col("ts") >= cut_ts(events, 3, 4))
             .select(F.col("user_id").cast("string").alias("city"),
                     F.to_date("ts").alias("day")))
    s = _tables(spark, sf_dir).silver.drop("ingested_at")
    return lookups.semi_match(s, batch, ["city", "day"])


@register("key_check", with_base("""
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE city IS NULL OR event_time IS NULL) AS null_key_rows,
       (SELECT count(*) FROM (SELECT 1 FROM silver GROUP BY city, event_time
                              HAVING count(*) > 1)) AS duplicate_keys
FROM silver"""))
def q_key_check(spark, sf_dir):
    """Q1 on silver: no null and no repeated (key, event_time)."""
    return checks.key_check(_tables(spark, sf_dir).silver, ["city", "event_time"])


@register("key_check_raw", with_base("""
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE city IS NULL OR event_time IS NULL) AS null_key_rows,
       (SELECT count(*) FROM (SELECT 1 FROM valid GROUP BY city, event_time
                              HAVING count(*) > 1)) AS duplicate_keys
FROM valid"""))
def q_key_check_raw(spark, sf_dir):
    """Q1 on the gated rows before de-duplication (finds the re-deliveries)."""
    return checks.key_check(silver.gate(typed_events(spark, sf_dir)), ["city", "event_time"])


# ---------------------------------------------------------------- generic uses
@register("latest_order_per_customer", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def q_latest_order(spark, sf_dir):
    """A3 on orders: newest order per customer (lowest order key on ties)."""
    orders = ev.read_table(spark, sf_dir, "orders")
    return gold.latest_by(orders, ["o_custkey"],
                          [F.col("o_orderdate").desc(), F.col("o_orderkey")],
                          ["o_custkey", "o_orderkey", "o_orderdate", "o_totalprice",
                           "o_orderstatus"])


@register("ship_month_stats", f"""
SELECT l_returnflag, date_trunc('month', l_shipdate) AS ship_month,
       {AVG.replace('temperature_c', 'l_extendedprice')} AS avg_price,
       max(l_extendedprice) AS max_price, min(l_extendedprice) AS min_price,
       CAST(count(l_extendedprice) AS INTEGER) AS line_count
FROM lineitem GROUP BY ALL""")
def q_ship_month(spark, sf_dir):
    """A1 on lineitem: monthly price stats per return flag."""
    li = ev.read_table(spark, sf_dir, "lineitem")
    return gold.bucket_stats(li, ["l_returnflag"], F.date_trunc("month", F.col("l_shipdate")),
                             "ship_month", "l_extendedprice", DEFAULT,
                             ("avg_price", "max_price", "min_price", "line_count"))
