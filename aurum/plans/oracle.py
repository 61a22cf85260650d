"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The common prefix turns ``events`` into messages exactly as
``sources.events`` does, then applies the gate, the keep-last rule and the gold
roll-ups with the same exact-sum mean and half-even rounding.
"""

from __future__ import annotations

from ..config import DEFAULT
from ..functions import rules
from ..functions.numbers import exact_mean_sql

CFG = DEFAULT
AVG = f"round_even({exact_mean_sql('temperature_c', CFG.mean_scale)} * 100, 0) / 100"
COND = rules.condition_case_sql("k")

BASE = f"""
msg AS (
  SELECT event_id AS src_offset, CAST(user_id AS VARCHAR) AS city,
         time_bucket(INTERVAL '15 minutes', ts) AS event_time,
         value AS temperature_c,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         ts AS fetched_at
  FROM events),
typed AS (
  SELECT src_offset, city, event_time, temperature_c,
         CAST(k + 10 AS DOUBLE) AS humidity_pct,
         CAST(k - 5 AS DOUBLE) AS wind_speed_kmh,
         CAST(k AS DOUBLE) AS weather_code,
         {COND} AS condition, fetched_at
  FROM msg),
valid AS (
  SELECT * FROM typed
  WHERE temperature_c BETWEEN {CFG.temp_min} AND {CFG.temp_max}
    AND humidity_pct BETWEEN {CFG.humidity_min} AND {CFG.humidity_max}
    AND wind_speed_kmh >= {CFG.wind_min}),
silver AS (
  SELECT city, event_time, temperature_c, CAST(humidity_pct AS INTEGER) AS humidity_pct,
         wind_speed_kmh, CAST(weather_code AS INTEGER) AS weather_code, condition,
         CAST(event_time AS DATE) AS day
  FROM valid
  QUALIFY row_number() OVER (PARTITION BY city, event_time
                             ORDER BY fetched_at DESC, src_offset DESC) = 1),
latest AS (
  SELECT city, event_time, temperature_c, humidity_pct, condition FROM silver
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY event_time DESC) = 1),
latest_full AS (
  SELECT city, event_time, temperature_c, humidity_pct, wind_speed_kmh, condition FROM silver
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY event_time DESC) = 1),
hourly AS (
  SELECT city, date_trunc('hour', event_time) AS hour_start, {AVG} AS avg_temp,
         max(temperature_c) AS max_temp, min(temperature_c) AS min_temp,
         CAST(count(temperature_c) AS INTEGER) AS readings
  FROM silver GROUP BY city, date_trunc('hour', event_time)),
daily AS (
  SELECT city, day, {AVG} AS avg_temp,
         max(temperature_c) AS max_temp, min(temperature_c) AS min_temp,
         CAST(count(temperature_c) AS INTEGER) AS readings,
         max(temperature_c) > {CFG.heatwave_threshold} AS heatwave
  FROM silver GROUP BY city, day)
"""


def with_base(body: str) -> str:
    return "WITH " + BASE.strip() + "\n" + body.strip()


def emoji_values_sql() -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in rules.EMOJI.items())
    return f"(VALUES {rows}) AS e(condition, emoji)"
