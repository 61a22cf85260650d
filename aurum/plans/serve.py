"""Serving queries V1-V15 over a ``Tables`` bundle.  Each returns a lazy
DataFrame; sorting is presentation only (global range sort, no single-task
window) and top-k uses ``orderBy().limit()`` -> TakeOrderedAndProject.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, rules, times
from ..operators import gold, lookups
from .tables import Tables

DAILY_COLS = ["city", "day", "avg_temp", "max_temp", "min_temp", "readings", "heatwave"]
HOURLY_COLS = ["city", "hour_start", "avg_temp", "max_temp", "min_temp", "readings"]
RECENT_COLS = ["city", "event_time", "temperature_c", "humidity_pct", "condition"]


def _as_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def city_latest(t: Tables) -> DataFrame:
    """V1: latest reading per key, by key."""
    return t.latest.select(*gold.LATEST_COLS).orderBy("city")


def daily_stats(t: Tables) -> DataFrame:
    """V2."""
    return t.daily.select(*DAILY_COLS).orderBy("day", "city")


def hourly_stats(t: Tables) -> DataFrame:
    """V3."""
    return t.hourly.select(*HOURLY_COLS).orderBy("hour_start", "city")


def recent_readings(t: Tables, hours: int = 24, as_of=None) -> DataFrame:
    """Readings with event_time >= as_of - hours (inclusive, no upper
    bound).  A derived ``day >=`` predicate lets the scan prune partitions."""
    as_of = F.current_timestamp() if as_of is None else _as_col(as_of)
    lo = as_of - F.make_dt_interval(hours=F.lit(int(hours)))
    return (t.silver.where(F.col("day") >= times.day_bucket(lo, t.cfg.tz))
                    .where(F.col("event_time") >= lo)
                    .select(*RECENT_COLS).orderBy("event_time", "city"))


def latest_full(t: Tables) -> DataFrame:
    """V5: latest full silver row per key (incl. wind)."""
    return gold.build_latest(t.silver, gold.LATEST_FULL_COLS).orderBy("city")


def alerts(t: Tables, threshold: float | None = None,
           cities: Iterable[str] | None = None) -> DataFrame:
    """Keys whose latest temperature is strictly above the threshold."""
    th = t.cfg.alert_threshold if threshold is None else threshold
    lat = lookups.key_filter(t.latest, cities, t.latest)
    return (lat.where(F.col("temperature_c") > F.lit(th))
               .select("city", "temperature_c",
                       numbers.display(F.col("temperature_c"), 0).alias("temp_label"))
               .orderBy("city"))


def kpi_row(t: Tables, cities: Iterable[str] | None = None) -> DataFrame:
    """V7: live keys, hottest and coolest key (first key on ties), flagged keys
    on the latest day (the day maximum is taken before the key filter)."""
    lat = lookups.key_filter(t.latest, cities, t.latest)
    temp = F.col("temperature_c")
    # flagged chosen keys per day, then the count of the newest day (taken over
    # all keys): one aggregation pass over daily
    pred = lookups.key_predicate(cities, t.latest)
    hot = F.col("heatwave") if pred is None else (F.col("heatwave") & pred)
    flagged = (t.daily.groupBy("day").agg(F.count_if(hot).alias("n"))
               .select(F.max_by("n", "day")).scalar())
    return lat.select(
        F.count(F.lit(1)).alias("live_keys"),
        F.min_by("city", F.when(temp.isNotNull(), F.struct(-temp, F.col("city"))))
         .alias("hottest_city"),
        F.max(temp).alias("hottest_temp"),
        F.min_by("city", F.when(temp.isNotNull(), F.struct(temp, F.col("city"))))
         .alias("coolest_city"),
        F.min(temp).alias("coolest_temp"),
    ).withColumn("heatwave_keys", F.coalesce(flagged, F.lit(0)).cast("bigint"))


def ranked_cards(t: Tables, cities: Iterable[str] | None = None,
                 ascending: bool = False) -> DataFrame:
    """V8: keys ranked by latest temperature with emoji, hottest first, or
    coolest first for bars that grow upwards."""
    temp = F.col("temperature_c")
    lat = lookups.key_filter(t.latest, cities, t.latest)
    spark = t.latest.sparkSession
    return (lookups.with_emoji(lat, spark)
            .select("city", "temperature_c", "condition", "emoji",
                    numbers.display(F.col("temperature_c"), 1).alias("temp_label"))
            .orderBy(temp.asc_nulls_last() if ascending else temp.desc_nulls_last(), "city"))


def map_points(t: Tables, locations: DataFrame, cities: Iterable[str] | None = None,
               fixed_size: bool = False) -> DataFrame:
    """Latest temperature with the key's location; keys without a
    location are dropped."""
    lat = lookups.key_filter(t.latest, cities, t.latest).select("city", "temperature_c")
    return lookups.lookup_inner(lat, locations, "city", fixed_size).orderBy("city")


def spotlight(t: Tables, city) -> DataFrame:
    """The full latest row of one key."""
    return lookups.key_equals(gold.build_latest(t.silver, gold.LATEST_FULL_COLS), city)


def hottest_key(t: Tables) -> Column:
    """The hottest latest key as a scalar-subquery column (first key on ties)."""
    temp = F.col("temperature_c")
    return t.latest.select(
        F.min_by("city", F.when(temp.isNotNull(), F.struct(-temp, F.col("city"))))).scalar()


def trend(t: Tables, hours: int = 12, cities: Iterable[str] | None = None,
          as_of=None) -> DataFrame:
    """Recent readings of the chosen keys."""
    rec = recent_readings(t, hours, as_of)
    return lookups.key_filter(rec, cities, t.latest).orderBy("event_time", "city")


def daily_flag_labels(t: Tables, cities: Iterable[str] | None = None) -> DataFrame:
    """Daily max with a day label and the flag label."""
    d = lookups.key_filter(t.daily, cities, t.latest)
    return d.select("city", times.day_label(F.col("day")).alias("day"), "max_temp",
                    rules.flag_label(F.col("heatwave")).alias("flag")).orderBy("day", "city")


def hour_pivot(t: Tables, cities: Iterable[str] | None = None,
               labels: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Key x 'MM-dd HH:00' matrix of mean avg_temp.  Years share a
    label.  Passing ``labels`` skips the job that lists the distinct labels and
    shows only those; with ``strict``, data outside them is an error."""
    h = lookups.key_filter(t.hourly, cities, t.latest)
    h = h.select("city", times.hour_label(F.col("hour_start"), t.cfg.tz).alias("hour"),
                 "avg_temp")
    # the mean per cell first: the pivot then only places values
    h = h.groupBy("city", "hour").agg(
        numbers.exact_mean(F.col("avg_temp"), t.cfg.mean_scale).alias("avg_temp"))
    g = h.groupBy("city")
    if labels is None:
        g = g.pivot("hour")
    else:
        outside = None if not strict else h.where(
            ~F.col("hour").isin(list(labels))).select("hour").first()
        if outside:
            raise ValueError(f"hour label {outside[0]} is not in the given list")
        g = g.pivot("hour", sorted(labels))
    return g.agg(F.max("avg_temp")).orderBy("city")  # one value per cell by now


def heatwave_days(t: Tables) -> DataFrame:
    """V14 / F6."""
    return t.daily.where("heatwave").select(*DAILY_COLS).orderBy("day", "city")


def newest_readings(t: Tables, n: int = 20) -> DataFrame:
    """V15 / O6 + P15: newest n rows with their partition (top-k)."""
    cols = ["day", "city", "event_time", "temperature_c", "humidity_pct",
            "wind_speed_kmh", "weather_code", "condition"]
    return (t.silver.select(*cols)
            .orderBy(F.col("event_time").desc(), F.col("city")).limit(int(n)))


def register_views(t: Tables, prefix: str = "v_") -> list[str]:
    """Expose the serving queries with default parameters as temporary views
    (``v_city_latest``, ``v_kpi_row``, ...) for SQL users; the recent-window
    views are relative to the current time."""
    views = {
        "city_latest": city_latest(t), "daily_stats": daily_stats(t),
        "hourly_stats": hourly_stats(t), "recent_readings": recent_readings(t),
        "latest_full": latest_full(t), "alerts": alerts(t), "kpi_row": kpi_row(t),
        "ranked_cards": ranked_cards(t), "trend": trend(t),
        "daily_flag_labels": daily_flag_labels(t), "heatwave_days": heatwave_days(t),
        "newest_readings": newest_readings(t), "spotlight": spotlight(t, hottest_key(t)),
        "map_points": map_points(t, lookups.city_dim(t.latest.sparkSession), fixed_size=True),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return sorted(prefix + n for n in views)
