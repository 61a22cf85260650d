"""Key checks (Q1): uniqueness and not-null in one aggregation pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: total rows, rows with a null key part, keys seen more than once.
    Per-key counts are a partial/final hash aggregate, so a hot key is fine."""
    any_null = None
    for k in keys:
        c = F.col(k).isNull()
        any_null = c if any_null is None else (any_null | c)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.select(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).cast("bigint")
         .alias("null_key_rows"),
        F.count_if(F.col("_n") > 1).cast("bigint").alias("duplicate_keys"),
    )


def assert_keys(df: DataFrame, keys: list[str]) -> None:
    """Raise if any key is null or duplicated (a one-row action)."""
    row = key_check(df, keys).first()
    if row["null_key_rows"] or row["duplicate_keys"]:
        raise ValueError(f"key check failed on {keys}: {row.asDict()}")
