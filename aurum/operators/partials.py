"""Mergeable partial states of the roll-ups.

``partials`` holds one row per key and hour: count, exact decimal sum, largest,
smallest and last reading.  Two such rows of an hour merge into one, so a batch is
folded in from the rows it inserted alone; hourly, daily and latest follow from
the states, and no stored silver row is read for them.  A batch costs its own rows
and the states of its days (at most 24 a key and day), however many readings those
days hold.

Folding is not idempotent, so it is done once for each batch of inserted rows:

1. the rows to insert are written to ``pending/<id>``;
2. they are folded, and the manifest that switches to the new states names the id;
3. they are appended to silver, but for those already there;
4. ``pending/<id>`` is removed.

``recover`` takes up what a job that died has left: an unfinished folder of step 1
is removed, any other goes through steps 2 to 4, of which 2 is left out if the
manifest has the id.  States come before silver, so that a reader which follows
silver finds its rows in them.

Null readings count for nothing in count, sum, largest and smallest, as in the
aggregates; an hour of null readings keeps its row.  Empty batches write nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session
from ..config import Config
from ..functions import numbers, times
from . import merge

#: Integer digits that are left to a sum of this type: 26, whatever the mean's scale.
TOTAL = "decimal(38,12)"
MAX_SCALE = 12
LAST = {"last_time": "event_time", "last_temp": "temperature_c", "last_humidity": "humidity_pct",
        "last_condition": "condition"}
COLS = ["city", "hour_start", "n", "total", "max_temp", "min_temp", *LAST, "day"]


def of_rows(silver: DataFrame, cfg: Config) -> DataFrame:
    """States of silver rows, which are unique on (city, event_time)."""
    if cfg.mean_scale > MAX_SCALE:
        raise ValueError(f"mean_scale is at most {MAX_SCALE}")
    x = F.col("temperature_c")
    exact = x.cast(f"decimal({16 + cfg.mean_scale},{cfg.mean_scale})")
    last = F.max(F.struct(*[F.col(c).alias(a) for a, c in LAST.items()]))
    return (silver.groupBy("city", "day", times.hour_bucket(F.col("event_time"), cfg.tz).alias("hour_start"))
            .agg(F.count(x).alias("n"), F.sum(exact).cast(TOTAL).alias("total"), F.max(x).alias("max_temp"),
                 F.min(x).alias("min_temp"), last.alias("last"))
            .select(*[c if c not in LAST else f"last.{c}" for c in COLS]))


def merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of one group of ``keys`` as one."""
    return (states.groupBy(*keys)
            .agg(F.sum("n").alias("n"), F.sum("total").cast(TOTAL).alias("total"), F.max("max_temp").alias("max_temp"),
                 F.min("min_temp").alias("min_temp"), F.max(F.struct(*LAST)).alias("last"))
            .select(*keys, "n", "total", "max_temp", "min_temp", *[f"last.{c}" for c in LAST]))


def _stats(states: DataFrame, bucket: list[str], cfg: Config) -> DataFrame:
    mean = F.col("total").cast("double") / F.col("n")
    return states.select("city", *bucket, numbers.round_half_even(mean, cfg.round_digits).alias("avg_temp"),
                         "max_temp", "min_temp", F.col("n").cast("int").alias("readings"), "day")


def hourly(states: DataFrame, cfg: Config) -> DataFrame:
    return _stats(states, ["hour_start"], cfg)


def daily(states: DataFrame, cfg: Config) -> DataFrame:
    return (_stats(merged(states, ["city", "day"]), [], cfg)
            .withColumn("heatwave", F.col("max_temp") > F.lit(cfg.heatwave_threshold)))


def latest(states: DataFrame) -> DataFrame:
    """Last reading of each key; a key's rows are unique by time, so there are no ties."""
    return (states.where(F.col("last_time").isNotNull()).groupBy("city")
            .agg(F.max(F.struct(*LAST)).alias("last"))
            .select("city", *[F.col(f"last.{a}").alias(c) for a, c in LAST.items()]))


# ------------------------------------------------------------------ the store
def _folder(lake, pid: str) -> str:
    return f"{lake.root}/pending/{pid}"


def _pending(lake) -> list[str]:
    return [n for n in session.child_names(lake.spark, f"{lake.root}/pending") if n[0] not in "._"]


def ensure(lake) -> None:
    """States of a store that was written without them, from its silver rows."""
    table, rows = lake.table("partials"), lake.table("silver")
    if not table.manifest.numbers() and (rows.manifest.numbers() or any(
            n.startswith("day=") for n in session.child_names(lake.spark, rows.path))):
        rebuild(lake)


def rebuild(lake) -> None:
    """All states anew from silver, switched to at once."""
    lake.table("partials").replace(of_rows(lake.read("silver"), lake.cfg), None)


def recompute(lake, touched: DataFrame, days: list, small: bool = False) -> None:
    """States of some (city, day) pairs anew from all their silver rows (R4), for repairs.
    Hours of these pairs that silver does not have go."""
    current = lake.table("partials").read(days)
    pairs = F.broadcast(touched) if small else touched
    rest = current.join(pairs, ["city", "day"], "left_anti").select(*COLS)
    rows = of_rows(lake.silver_for_keys(touched, days, broadcast=small), lake.cfg)
    lake.table("partials").replace(rest.unionByName(rows), days)


def insert(lake, new_rows: DataFrame) -> int:
    """Put rows that silver does not have into the states and silver; returns their number."""
    pid = uuid.uuid4().hex
    new_rows.select(*lake.schema("silver").names).write.parquet(_folder(lake, pid))
    return _finish(lake, pid, again=False)


def recover(lake) -> int:
    """Finish what jobs that died have begun; returns the rows inserted by that.
    For the writer of silver only."""
    done = 0
    for pid in _pending(lake):
        if session.path_exists(lake.spark, f"{_folder(lake, pid)}/_SUCCESS"):
            done += _finish(lake, pid, again=True)
        else:
            session.delete(lake.spark, _folder(lake, pid))
    return done


def _finish(lake, pid: str, again: bool) -> int:
    spark, schema = lake.spark, lake.schema("silver")
    rows = spark.read.schema(schema).parquet(_folder(lake, pid))
    counts = {r["day"]: r["n"] for r in rows.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, days = sum(counts.values()), sorted(counts)
    if total:
        small = total <= lake.cfg.broadcast_touched_rows
        folded = (lake.table("partials").state()[1].get("note") or {}).get("folded", [])
        if pid not in folded:
            _fold(lake, rows, days, small, [p for p in folded if p in _pending(lake)] + [pid])
        if again:
            rows = merge.merge_plan(spark, lake.path("silver"), rows, ["city", "event_time"], "day", "ignore",
                                    schema, days, small_updates=small)
        merge.write_partitioned(rows, lake.path("silver"), "day", "append", ["event_time"])
    session.delete(spark, _folder(lake, pid))
    return total


def _fold(lake, rows: DataFrame, days: list, small: bool, folded: list[str]) -> None:
    """Merge the rows' states into those of their hours.  Other rows of the days are
    copied without a shuffle if the batch's hours (at most its rows) are few; if not,
    all states of the days are grouped once, in which a state that is alone stays as it is."""
    keys = ["city", "day", "hour_start"]
    table, new = lake.table("partials"), of_rows(rows, lake.cfg)
    current = table.stored(days)
    if current is None:
        out = new
    elif small:
        current, hours = current.select(*COLS), F.broadcast(new.select(*keys))
        known = current.join(hours, keys, "left_semi").select(*COLS)
        rest = current.join(hours, keys, "left_anti").select(*COLS)
        out = rest.unionByName(merged(known.unionByName(new), keys).select(*COLS))
    else:
        out = merged(current.select(*COLS).unionByName(new), keys).select(*COLS)
    table.replace(out, days, note={"folded": folded})
