"""Declared schemas of the message, the medallion tables and the dimensions."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Flat message fields (FX1).  Every field is read as STRING and typed later, so
# a bad value becomes null instead of failing the record.
MESSAGE_FIELDS = ["city", "event_time", "temperature_c", "humidity_pct",
                  "wind_speed_kmh", "weather_code", "fetched_at"]

MESSAGE_SCHEMA = StructType([StructField(f, StringType()) for f in MESSAGE_FIELDS])

# Landed weather-API payload: {"current": {...}}.
API_PAYLOAD_SCHEMA = StructType([
    StructField("current", StructType([
        StructField("time", StringType()),
        StructField("temperature_2m", StringType()),
        StructField("relative_humidity_2m", StringType()),
        StructField("wind_speed_10m", StringType()),
        StructField("weather_code", StringType()),
    ])),
])

BRONZE_SCHEMA = StructType([
    StructField("raw_json", StringType()),
    StructField("source", StringType()),
    StructField("src_offset", LongType()),
    StructField("src_time", TimestampType()),
    StructField("is_malformed", BooleanType()),
    StructField("ingested_at", TimestampType()),
    StructField("batch_id", LongType()),
    StructField("slice", StringType()),
])  # partitioned by slice: a micro-batch (``2026-06-25.b12``, which a replay overwrites)
#   or the batches of a day that were merged up to one (``2026-06-25.m12``)

SILVER_COLUMNS = ["city", "event_time", "temperature_c", "humidity_pct",
                  "wind_speed_kmh", "weather_code", "condition", "ingested_at"]

SILVER_SCHEMA = StructType([
    StructField("city", StringType()),
    StructField("event_time", TimestampType()),
    StructField("temperature_c", DoubleType()),
    StructField("humidity_pct", IntegerType()),
    StructField("wind_speed_kmh", DoubleType()),
    StructField("weather_code", IntegerType()),
    StructField("condition", StringType()),
    StructField("ingested_at", TimestampType()),
    StructField("day", DateType()),
])

LATEST_SCHEMA = StructType([
    StructField("city", StringType()),
    StructField("event_time", TimestampType()),
    StructField("temperature_c", DoubleType()),
    StructField("humidity_pct", IntegerType()),
    StructField("condition", StringType()),
    StructField("bucket", IntegerType()),
])

HOURLY_SCHEMA = StructType([
    StructField("city", StringType()),
    StructField("hour_start", TimestampType()),
    StructField("avg_temp", DoubleType()),
    StructField("max_temp", DoubleType()),
    StructField("min_temp", DoubleType()),
    StructField("readings", IntegerType()),
    StructField("day", DateType()),
])

DAILY_SCHEMA = StructType([
    StructField("city", StringType()),
    StructField("avg_temp", DoubleType()),
    StructField("max_temp", DoubleType()),
    StructField("min_temp", DoubleType()),
    StructField("readings", IntegerType()),
    StructField("heatwave", BooleanType()),
    StructField("day", DateType()),
])

# Mergeable states of the roll-ups, one row per key and hour.
PARTIALS_SCHEMA = StructType([
    StructField("city", StringType()),
    StructField("hour_start", TimestampType()),
    StructField("n", LongType()),
    StructField("total", DecimalType(38, 12)),
    StructField("max_temp", DoubleType()),
    StructField("min_temp", DoubleType()),
    StructField("last_time", TimestampType()),
    StructField("last_temp", DoubleType()),
    StructField("last_humidity", IntegerType()),
    StructField("last_condition", StringType()),
    StructField("day", DateType()),
])

RUN_LOG_SCHEMA = StructType([
    StructField("batch_id", LongType()),
    StructField("messages_in", LongType()),
    StructField("malformed", LongType()),
    StructField("silver_rows", LongType()),
    StructField("silver_inserted", LongType()),
    StructField("touched_days", LongType()),
    StructField("logged_at", TimestampType()),
    StructField("tier", StringType()),     # null: the one-query form
    StructField("lag_s", DoubleType()),    # age of the newest message when it was logged
])
