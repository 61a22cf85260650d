"""Gold roll-ups from silver (A1, A2, A3, W2) and the generic bucket statistic.

Stats are plain hash aggregates (partial aggregation before the shuffle, so a
hot key costs one row per map task).  The mean is computed from an exact
decimal sum, so it does not depend on partitioning or on the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import numbers, times


STAT_NAMES = ("avg_temp", "max_temp", "min_temp", "readings")


def stats_agg(measure: str, cfg: Config = DEFAULT, names=STAT_NAMES) -> list[Column]:
    x = F.col(measure)
    avg_n, max_n, min_n, cnt_n = names
    return [
        numbers.round_half_even(numbers.exact_mean(x, cfg.mean_scale), cfg.round_digits)
        .alias(avg_n),
        F.max(x).alias(max_n),
        F.min(x).alias(min_n),
        F.count(x).cast("int").alias(cnt_n),
    ]


def bucket_stats(df: DataFrame, keys: list[str], bucket: Column, bucket_name: str,
                 measure: str, cfg: Config = DEFAULT, names=STAT_NAMES) -> DataFrame:
    """mean (rounded), max, min, count of ``measure`` by keys + time bucket."""
    return (df.groupBy(*[F.col(k) for k in keys], bucket.alias(bucket_name))
              .agg(*stats_agg(measure, cfg, names)))


def build_hourly(silver: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(city, hour_start) stats (A1); ``day`` of the hour kept for partitioning."""
    out = bucket_stats(silver, ["city"], times.hour_bucket(F.col("event_time"), cfg.tz),
                       "hour_start", "temperature_c", cfg)
    return out.withColumn("day", times.day_bucket(F.col("hour_start"), cfg.tz))


def build_daily(silver: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(city, day) stats with the heatwave flag (A2)."""
    out = bucket_stats(silver, ["city"], times.day_bucket(F.col("event_time"), cfg.tz),
                       "day", "temperature_c", cfg)
    return out.withColumn("heatwave", F.col("max_temp") > F.lit(cfg.heatwave_threshold))


def build_hourly_daily(silver: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Hourly and daily stats in one pass: GROUPING SETS ((city, day, hour),
    (city, day)) reads silver once and shuffles partial aggregates once.  Rows
    carry ``_gid`` (0 = hourly, 1 = daily); split them with ``split_hourly_daily``.
    Persist the result when both halves are used (it is gold-sized)."""
    df = silver.select(
        "city", times.day_bucket(F.col("event_time"), cfg.tz).alias("day"),
        times.hour_bucket(F.col("event_time"), cfg.tz).alias("hour_start"), "temperature_c")
    return (df.groupingSets([["city", "day", "hour_start"], ["city", "day"]],
                            "city", "day", "hour_start")
              .agg(*stats_agg("temperature_c", cfg), F.grouping_id().alias("_gid")))


def split_hourly_daily(both: DataFrame, cfg: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    stats = list(STAT_NAMES)
    hourly = both.where(F.col("_gid") == 0).select("city", "hour_start", *stats, "day")
    daily = (both.where(F.col("_gid") == 1).select("city", *stats, "day")
             .withColumn("heatwave", F.col("max_temp") > F.lit(cfg.heatwave_threshold)))
    return hourly, daily


def latest_by(df: DataFrame, keys: list[str], order: list[Column],
              cols: list[str] | None = None) -> DataFrame:
    """First row per key under ``order`` (row_number = 1 -> partial
    WindowGroupLimit before the shuffle, so hot keys are cut map-side)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = (df.withColumn("_rn", F.row_number().over(w))
             .where(F.col("_rn") == 1).drop("_rn"))
    return out.select(*cols) if cols else out


LATEST_COLS = ["city", "event_time", "temperature_c", "humidity_pct", "condition"]
LATEST_FULL_COLS = ["city", "event_time", "temperature_c", "humidity_pct",
                    "wind_speed_kmh", "condition"]


def build_latest(silver: DataFrame, cols: list[str] = LATEST_COLS) -> DataFrame:
    """Latest reading per key (A3 / W2 / W3); rows without a time are skipped,
    equal times resolve to the first row in (event_time desc) order."""
    return latest_by(silver.where(F.col("event_time").isNotNull()), ["city"],
                     [F.col("event_time").desc()], cols)


def latest_bucket(key: Column, cfg: Config = DEFAULT) -> Column:
    """Hash bucket of the key: the overwrite unit of the latest table."""
    return F.pmod(F.xxhash64(key), F.lit(cfg.latest_buckets)).cast("int")


def with_latest_bucket(latest: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return latest.withColumn("bucket", latest_bucket(F.col("city"), cfg))
