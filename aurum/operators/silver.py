"""Typed messages -> clean silver rows (F1, F2, W1, P6, P7) and rejects.

De-duplication keeps the last delivery of a (key, event_time) by fetch time.
It is a ``row_number() = 1`` filter, which Spark plans as a partial
``WindowGroupLimit`` before the shuffle: a hot key with millions of copies is
cut to one row per map task before it moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import numbers, rules, times

KEYS = ["city", "event_time"]
VALUES = ("temperature_c", "humidity_pct", "wind_speed_kmh", "weather_code")


def gate(typed: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Rows with a key and sane readings (F1 + F2)."""
    return (typed.where(F.col("city").isNotNull() & F.col("event_time").isNotNull())
                 .where(rules.is_valid_reading(F.col("temperature_c"), F.col("humidity_pct"),
                                               F.col("wind_speed_kmh"), cfg)))


def rejects(typed: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Rows the gate drops, with the first failed check as ``reason``."""
    has_key = F.when(F.col("city").isNotNull() & F.col("event_time").isNotNull(), F.lit(1))
    reason = rules.reject_reason(has_key, F.col("temperature_c"), F.col("humidity_pct"),
                                 F.col("wind_speed_kmh"), cfg)
    return typed.withColumn("reason", reason).where(F.col("reason").isNotNull())


def dedup_order(position: tuple[str, ...] = (), values: tuple[str, ...] = ()) -> list:
    """Total order of copies, best first: a missing fetch time wins (it sorts
    last in the original rule and the last copy is kept), then the latest
    fetch instant, then its text, then the latest source position, then the
    values themselves, so that copies without a position resolve alike in every
    run."""
    order = [F.col("fetched_at").isNull().desc(),
             F.col("fetched_ts").desc_nulls_last(),
             F.col("fetched_at").desc_nulls_last()]
    return order + [F.col(c).desc_nulls_last() for c in (*position, *values)]


def position(columns: list[str]) -> tuple[str, ...]:
    """What tells the arrival order, as far as it is there: the file's time and name
    (messages of a topic have none: copies of a key share a partition), the offset or
    block, and the place in it."""
    of_file = ("src_time", "source") if "src_time" in columns else ()
    return tuple(c for c in (*of_file, "src_block", "src_offset", "src_place") if c in columns)


def dedup_last(valid: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Keep one row per key: the last delivery."""
    if "fetched_at" not in valid.columns:
        valid = valid.withColumn("fetched_at", F.lit(None).cast("string"))
    if "fetched_ts" not in valid.columns:
        valid = valid.withColumn("fetched_ts", F.lit(None).cast("timestamp"))
    values = tuple(c for c in VALUES if c in valid.columns)
    w = Window.partitionBy(*keys).orderBy(*dedup_order(position(valid.columns), values))
    return (valid.withColumn("_rn", F.row_number().over(w))
                 .where(F.col("_rn") == 1).drop("_rn"))


def project_silver(df: DataFrame, cfg: Config = DEFAULT, ingested_at=None) -> DataFrame:
    """Silver column order and types (P6, P7) plus the ``day`` partition."""
    ingested = ingested_at if ingested_at is not None else F.current_timestamp()
    return df.select(
        F.col("city").cast("string").alias("city"),
        F.col("event_time").cast("timestamp").alias("event_time"),
        F.col("temperature_c").cast("double").alias("temperature_c"),
        numbers.to_int_rounded(F.col("humidity_pct").cast("double")).alias("humidity_pct"),
        F.when(~F.isnan(F.col("wind_speed_kmh")), F.col("wind_speed_kmh"))
         .cast("double").alias("wind_speed_kmh"),
        numbers.to_int_rounded(F.col("weather_code").cast("double")).alias("weather_code"),
        F.col("condition").cast("string").alias("condition"),
        ingested.cast("timestamp").alias("ingested_at"),
        times.day_bucket(F.col("event_time"), cfg.tz).alias("day"),
    )


def to_silver(typed: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Typed messages -> silver rows: gate, de-duplicate, project."""
    return project_silver(dedup_last(gate(typed, cfg)), cfg)
