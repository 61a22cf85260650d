"""The driver's ``events`` table as a keyed reading stream.

Mapping (one reading per event): key = user id, event time = start of the
15-minute slot of ``ts`` (minute precision, naive, like the weather API),
temperature = value, humidity = k + 10, wind = k - 5, code = k where k is the
integer in ``props``, fetched_at = ts with microseconds.  Several events of a
user in one slot are re-deliveries of one reading; the latest fetch wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import parse
from ..schemas import MESSAGE_FIELDS

SLOT_MINUTES = 15


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of the input's files for one task of per-row work: seconds of JSON and patterns.
TASK_BYTES = 1_000_000
#: Bytes of the input's files for one file of messages (about 25 MB of them): several
#: fit a task that reads them, so tasks get about equal shares whatever the cores.
FILE_BYTES = 1_000_000


def shares(df: DataFrame, size: int) -> int:
    """How many shares of ``size`` bytes the files have that ``df`` reads; no data is
    read.  1 for rows that are in no file."""
    try:
        return max(1, -(-session.total_size(df.sparkSession, df.inputFiles()) // size))
    except Exception:  # sessions without access to file systems (Spark Connect)
        return 1


def spread(df: DataFrame) -> DataFrame:
    """Deal rows over all cores, and over more tasks the larger the input, before
    CPU-heavy per-row work (JSON, regex).  The scan's own splits do not do that: a
    row group is read by one of them, whole, so a file of one row group has one task
    with rows, however many splits the plan counts.  Rows go by a hash of all their
    columns, so that a repeated or null key does not gather them and a task that
    runs again deals them alike."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # sessions without a context (Spark Connect)
        return df
    return df.repartition(max(cores, shares(df, TASK_BYTES)), *[F.col(c) for c in df.columns])


def props_k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def slot_text(ts: Column) -> Column:
    """'yyyy-MM-ddTHH:mm' of the slot start (NTZ wall clock, no zone)."""
    minute = (F.floor(F.minute(ts) / SLOT_MINUTES) * SLOT_MINUTES).cast("int")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:"),
                    F.lpad(minute.cast("string"), 2, "0"))


def message_struct(events: DataFrame) -> Column:
    k = props_k(F.col("props"))
    return F.struct(
        F.col("user_id").cast("string").alias("city"),
        slot_text(F.col("ts")).alias("event_time"),
        F.col("value").alias("temperature_c"),
        (k + 10).alias("humidity_pct"),
        (k - 5).alias("wind_speed_kmh"),
        k.alias("weather_code"),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetched_at"),
    )


def events_as_messages(events: DataFrame) -> DataFrame:
    """events -> (src_offset, key, value JSON, ts): the shape a Kafka source or
    a landing directory delivers.  Only the needed columns are read."""
    return messages_of(dealt(events))


def dealt(events: DataFrame) -> DataFrame:
    """The columns that messages are made of, dealt over all cores.  Callers that make
    messages of several parts persist these rows: they are narrow, and a file of one row
    group is then read by its one task once, not for each part."""
    return spread(events.select("event_id", "user_id", "ts", "value", "props"))


def messages_of(events: DataFrame) -> DataFrame:
    """``events_as_messages`` of rows that have been dealt."""
    fields = events.select(F.col("event_id").alias("src_offset"),
                           F.col("user_id").cast("string").alias("key"), "ts",
                           message_struct(events).alias("m")).select("src_offset", "key",
                                                                     "ts", "m.*")
    return fields.select("src_offset", "key",
                         parse.to_message_json(fields, MESSAGE_FIELDS).alias("value"), "ts")


def events_as_api_payloads(events: DataFrame) -> DataFrame:
    """events -> landed weather-API responses (city, payload, fetched_at)."""
    events = spread(events.select("event_id", "user_id", "ts", "value", "props"))
    k = props_k(F.col("props"))
    current = F.struct(
        slot_text(F.col("ts")).alias("time"),
        F.col("value").alias("temperature_2m"),
        (k + 10).alias("relative_humidity_2m"),
        (k - 5).alias("wind_speed_10m"),
        k.alias("weather_code"),
    )
    return events.select(
        F.col("event_id").alias("src_offset"),
        F.col("user_id").cast("string").alias("city"),
        F.to_json(F.struct(current.alias("current"))).alias("payload"),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetched_at"),
    )
