"""Time coercion and zone-aware buckets.

The session clock is pinned to UTC (``session.prepare``); the business zone is
``Config.tz``.  Day partitions, touched days, hour and day buckets all use the
same expressions, so one clock decides every boundary.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO date or date-time; anything else (bare times, bare years, numbers) is
# refused, because a plain cast would turn "12:30" into today and "2026" into
# January 1st.
_ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?$"
_ZONE_SUFFIX = r"[T ].*(Z|[+-]\d{2}(:?\d{2})?)$"
_NO_SECONDS_WITH_ZONE = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(Z|[+-]\d{2}(:?\d{2})?)$"


def parse_event_time(s: Column, tz: str = "UTC") -> Column:
    """STRING -> TIMESTAMP instant, bad -> null.  An explicit offset is honoured;
    a naive string is wall-clock time in ``tz``."""
    s = F.trim(s)
    fixed = F.regexp_replace(s, _NO_SECONDS_WITH_ZONE, "$1:00$2")
    parsed = fixed.try_cast("timestamp")
    shaped = F.when(~s.rlike(_ISO_SHAPE), F.lit(None).cast("timestamp"))
    if tz.upper() == "UTC":  # with or without an offset, the same instant
        return shaped.otherwise(parsed)
    return shaped.when(s.rlike(_ZONE_SUFFIX), parsed).otherwise(F.to_utc_timestamp(parsed, tz))


def local_time(ts: Column, tz: str = "UTC") -> Column:
    return F.from_utc_timestamp(ts, tz) if tz.upper() != "UTC" else ts


def day_bucket(ts: Column, tz: str = "UTC") -> Column:
    """Calendar day of an instant in ``tz`` (DATE)."""
    return F.to_date(local_time(ts, tz))


def hour_bucket(ts: Column, tz: str = "UTC") -> Column:
    """Start of the hour of an instant in ``tz`` (TIMESTAMP instant).  With a
    half-hour zone the bucket starts on the UTC half hour."""
    if tz.upper() == "UTC":
        return F.date_trunc("hour", ts)
    # step back on the instant itself: a wall-clock hour that occurs twice
    # (clocks set back) stays two buckets
    into = F.pmod(F.unix_micros(local_time(ts, tz)), F.lit(3_600_000_000))
    return F.timestamp_micros(F.unix_micros(ts) - into)


def to_ntz(ts: Column) -> Column:
    """Instant -> UTC wall clock as TIMESTAMP_NTZ (what DuckDB calls TIMESTAMP)."""
    return ts.cast("timestamp_ntz")


def hour_label(ts: Column, tz: str = "UTC") -> Column:
    """'MM-dd HH:00' label (drops the year, as the heat-map axis does)."""
    return F.date_format(local_time(ts, tz), "MM-dd HH:00")


def day_label(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")
