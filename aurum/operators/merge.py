"""Keyed writes into partitioned Parquet tables.

Parquet has no MERGE, so one function covers the three write modes:

* ``ignore``           - insert-if-absent; rows whose key exists are dropped
                         and the rest appended (the table stays append-only).
* ``replace``          - upsert; touched partitions are rewritten as
                         (current rows not in updates) + updates.
* ``replace_if_newer`` - as ``replace`` but an update only wins over a stored
                         row with a strictly older time; a stored null time is
                         never replaced.

The partition column must be a function of the key, so a key lives in exactly
one partition and only the partitions the updates touch are read and
rewritten, beside the old ones; one manifest then switches all of them at once
(``sources.versioned``), so a job that dies loses nothing and leaves no half
state.  All modes are idempotent: replaying a batch leaves the table unchanged.
``updates`` must be unique on ``keys``; this is checked unless the caller has made them so.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.versioned import Versioned

MODES = ("ignore", "replace", "replace_if_newer")


def touched_values(updates: DataFrame, partition_col: str) -> list:
    """Distinct partition values of a batch (days or hash buckets: a small,
    bounded list, used for static partition pruning of the target)."""
    return [r[0] for r in updates.select(partition_col).distinct().collect()]


def write_partitioned(df: DataFrame, path: str, partition_col: str, mode: str,
                      order: list[str] | None = None) -> None:
    """Partitioned Parquet write with file sizes chosen by AQE: ``rebalance``
    groups rows by partition value and splits a hot value over several
    tasks, so a batch touching many days does not leave tasks x days small
    files, and a day holding most rows is not written by one task.  ``order``
    sorts the rows of each file, so that scans of a range skip row groups."""
    df = df.hint("rebalance", partition_col)
    if order:
        df = df.sortWithinPartitions(partition_col, *order)
    w = df.write.mode(mode)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.partitionBy(partition_col).parquet(path)


def read_partitions(spark: SparkSession, path: str, schema: StructType,
                    partition_col: str, values: list) -> DataFrame:
    """Target rows of the given partitions only.  Their folders are read by
    path, so the listing does not grow with the number of stored partitions."""
    return Versioned(spark, path, schema, partition_col).read(values)


def check_unique(updates: DataFrame, keys: list[str]) -> None:
    """Raise if a key occurs twice: both rows would be stored."""
    twice = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if twice is not None:
        raise ValueError(f"updates hold key {[twice[k] for k in keys]} {twice['n']} times")


def newer_only(updates: DataFrame, current: DataFrame, keys: list[str],
               time_col: str) -> DataFrame:
    """Updates that are new keys or strictly newer than the stored row."""
    cur = current.select(*keys, F.col(time_col).alias("_cur_t"), F.lit(True).alias("_hit"))
    joined = updates.join(cur, keys, "left")
    keep = F.col("_hit").isNull() | (F.col(time_col) > F.col("_cur_t"))
    return joined.where(F.coalesce(keep, F.lit(False))).drop("_cur_t", "_hit")


def merge_plan(spark: SparkSession, path: str, updates: DataFrame, keys: list[str],
               partition_col: str, mode: str, schema: StructType, values: list,
               time_col: str | None = None, small_updates: bool = False,
               within: Column | None = None) -> DataFrame:
    """The rows to write for a merge (appended for ``ignore``, overwriting
    the touched partitions otherwise), as a lazy DataFrame.  ``within`` (for
    ``ignore``) is a condition that every stored row with an update's key meets;
    it limits what is read of the partitions."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    updates = updates.select(*[f.name for f in schema.fields])
    current = Versioned(spark, path, schema, partition_col).stored(values)
    if current is None:  # partitions that are new: no stored row to match
        if mode == "replace_if_newer" and time_col is None:
            raise ValueError("replace_if_newer needs time_col")
        if mode != "ignore":  # its join also deals rows to the files that are appended
            return updates
        current = spark.createDataFrame([], schema)
    upd_keys = F.broadcast(updates.select(*keys)) if small_updates else updates.select(*keys)
    # stored rows whose key is in the batch (the only ones a join can match)
    matched = current.join(upd_keys, keys, "left_semi") if small_updates else current
    if mode == "ignore":
        if within is not None:
            matched = matched.where(within)
        return updates.join(matched.select(*keys), keys, "left_anti")
    if mode == "replace_if_newer":
        if time_col is None:
            raise ValueError("replace_if_newer needs time_col")
        updates = newer_only(updates, matched, keys, time_col)
        upd_keys = F.broadcast(updates.select(*keys)) if small_updates else updates.select(*keys)
    return current.join(upd_keys, keys, "left_anti").unionByName(updates)


def merge_keyed(spark: SparkSession, path: str, updates: DataFrame, keys: list[str],
                partition_col: str, mode: str, schema: StructType,
                time_col: str | None = None, values: list | None = None,
                small_updates: bool = False, observation: Observation | None = None,
                unique: bool = False) -> int:
    """Merge ``updates`` into the table at ``path``; returns the number of
    touched partitions (0 = nothing written).  ``values``, when the caller
    already knows them, are the partition values the updates touch.  ``unique``
    is for callers whose updates are unique on ``keys`` by construction.

    ``small_updates`` is for callers that have bounded the update count: the
    update keys are then broadcast and the target partitions are matched by
    a hash lookup where they are scanned, instead of being shuffled for the
    join (which AQE could only undo after the shuffle has run)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    own = values is None
    if own:  # several passes read the updates: evaluate them once
        updates = updates.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if own:
            values = touched_values(updates, partition_col)
        if not values:
            return 0
        if not unique:
            check_unique(updates, keys)
        rows = merge_plan(spark, path, updates, keys, partition_col, mode, schema, values,
                          time_col, small_updates)
        if observation is not None:
            rows = rows.observe(observation, F.count(F.lit(1)).alias("written"))
        if mode == "ignore":
            write_partitioned(rows, path, partition_col, "append")
        else:
            Versioned(spark, path, schema, partition_col).replace(rows, values)
        return len(values)
    finally:
        if own:
            updates.unpersist()
