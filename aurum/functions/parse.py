"""Message decoding: bytes -> string -> tolerant JSON -> typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..config import DEFAULT, Config
from ..schemas import API_PAYLOAD_SCHEMA, MESSAGE_FIELDS, MESSAGE_SCHEMA
from . import numbers, rules, times

# Only a single JSON object counts as a message (arrays, scalars, null and text
# after the object are malformed).  from_json stops where the first value ends, so
# the text is read as the first item of a list whose second one is END: text after
# the object breaks the list or shifts END.
_OBJECT_SHAPE = r"(?s)^\s*\{.*\}\s*$"
_END = "_end_of_message"

JSON_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def _as_list(v: Column, schema: StructType) -> Column:
    """The one ``from_json`` of a message: [object, END] if it is well-formed."""
    item = StructType([*schema.fields, StructField(_END, StringType())])
    return F.from_json(F.concat(F.lit("["), v, F.lit(f',{{"{_END}":1}}]')), ArrayType(item), JSON_OPTIONS)


def _one_object(raw: Column, items: Column) -> Column:
    """Is ``raw``, read by ``_as_list``, one JSON object?  Never null."""
    return F.coalesce(raw.rlike(_OBJECT_SHAPE) & (F.size(items) == 2)
                      & F.get(items, F.lit(1))[_END].isNotNull(), F.lit(False))


def value_as_string(value: Column) -> Column:
    """Kafka-style BINARY value -> STRING (strings pass through)."""
    return value.cast("string")


def decode_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds struct ``msg`` (all STRING fields) and ``is_malformed``.

    The raw text and its parsed struct come out of a one-element ``explode``:
    filters on the parsed fields cannot be pushed below a Generate, so the
    optimizer does not substitute ``from_json`` into every later predicate
    and each message is parsed exactly once (the row count is unchanged)."""
    v = F.col(value_col)
    pair = F.struct(v.alias("_raw"), _as_list(v, MESSAGE_SCHEMA).alias("_items"))
    others = [F.col(c) for c in df.columns if c != value_col]
    raw, items = F.col("_d._raw"), F.col("_d._items")
    return (df.select(*others, F.explode(F.array(pair)).alias("_d"))
              .select(*others, raw.alias(value_col), F.get(items, F.lit(0)).alias("msg"),
                      (~_one_object(raw, items)).alias("is_malformed")))


def type_message(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Typed view of decoded messages (P3, P4, P5), malformed ones removed."""
    return typed_beside(df.where(~F.col("is_malformed")), cfg).drop("is_malformed")


def typed_beside(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Decoded messages with typed columns in place of ``msg``: measures as DOUBLE,
    ``event_time`` as instant, label from the truncated code.  Keeps malformed rows
    and any other input column (e.g. the flag, the source position)."""
    m = {f: F.col(f"msg.{f}") for f in MESSAGE_FIELDS}
    fetched = m["fetched_at"]
    # behind a one-element explode each pattern and cast is worked out once a row, not
    # again in every filter and label that uses its value (see decode_json)
    typed = F.struct(
        times.parse_event_time(m["event_time"], cfg.tz).alias("event_time"),
        *[numbers.coerce_double(m[c]).alias(c)
          for c in ("temperature_c", "humidity_pct", "wind_speed_kmh", "weather_code")],
        times.parse_event_time(fetched, cfg.tz).alias("fetched_ts"))
    t = F.col("_typed")
    return (df.withColumn("_typed", F.explode(F.array(typed)))
              .withColumn("city", m["city"])
              .withColumn("event_time", t["event_time"])
              .withColumn("temperature_c", t["temperature_c"])
              .withColumn("humidity_pct", t["humidity_pct"])
              .withColumn("wind_speed_kmh", t["wind_speed_kmh"])
              .withColumn("weather_code", t["weather_code"])
              .withColumn("condition", rules.condition_from_code(t["weather_code"]))
              .withColumn("fetched_at", fetched)
              .withColumn("fetched_ts", t["fetched_ts"])
              .drop("msg", "_typed"))


def parse_messages(df: DataFrame, value_col: str = "value", cfg: Config = DEFAULT) -> DataFrame:
    """Raw message rows -> typed rows (malformed rows removed)."""
    return type_message(decode_json(df, value_col), cfg)


def flatten_api_payload(df: DataFrame, key_col: str = "city", payload_col: str = "payload",
                        fetched_col: str = "fetched_at") -> DataFrame:
    """Landed API response rows (key, payload JSON, fetch time) -> flat message
    JSON in ``value`` (R7).  A payload without ``current.time`` or that is not one
    JSON object is dropped, as for messages; the measures are optional."""
    others = [c for c in df.columns if c not in (key_col, payload_col, fetched_col)]
    raw = F.col(payload_col)
    # behind a one-element explode the payload is parsed once (see decode_json)
    pair = F.struct(raw.alias("raw"), _as_list(raw, API_PAYLOAD_SCHEMA).alias("p"))
    rows = df.select(*others, key_col, fetched_col, F.explode(F.array(pair)).alias("_d"))
    cur = F.when(_one_object(F.col("_d.raw"), F.col("_d.p")), F.get(F.col("_d.p"), F.lit(0))["current"])
    msg = F.struct(
        F.col(key_col).alias("city"),
        cur.getField("time").alias("event_time"),
        cur.getField("temperature_2m").alias("temperature_c"),
        cur.getField("relative_humidity_2m").alias("humidity_pct"),
        cur.getField("wind_speed_10m").alias("wind_speed_kmh"),
        cur.getField("weather_code").alias("weather_code"),
        F.col(fetched_col).alias("fetched_at"),
    )
    return (rows.where(cur.getField("time").isNotNull())
            .select(*others, F.to_json(msg).alias("value")))


def to_message_json(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Serialise rows to one JSON object string."""
    cols = cols or df.columns
    return F.to_json(F.struct(*[F.col(c) for c in cols]))
