"""Dimension lookups (J1, J2) and key filters.

Fixed dimensions (code labels, emoji, the polled cities) have a constant size
and are broadcast explicitly.  Dimensions that grow with the data get no hint:
the optimizer broadcasts them only under ``autoBroadcastJoinThreshold`` and
AQE re-plans from the measured shuffle size, otherwise a sort-merge join runs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules


def emoji_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(rules.EMOJI.items()), "condition string, emoji string")


def city_dim(spark: SparkSession) -> DataFrame:
    rows = [(c, lat, lon) for c, (lat, lon) in rules.CITIES.items()]
    return spark.createDataFrame(rows, "city string, lat double, lon double")


def with_emoji(df: DataFrame, spark: SparkSession, col: str = "condition") -> DataFrame:
    """Left lookup with a default."""
    dim = F.broadcast(emoji_dim(spark).withColumnRenamed("condition", "_cond"))
    out = df.join(dim, df[col].eqNullSafe(dim["_cond"]), "left")
    return (out.withColumn("emoji", F.coalesce(F.col("emoji"), F.lit(rules.EMOJI_DEFAULT)))
               .drop("_cond"))


def lookup_inner(df: DataFrame, dim: DataFrame, on: str | list[str],
                 fixed_size: bool = False) -> DataFrame:
    """Inner equi lookup (J1): unmatched keys are dropped.  ``fixed_size`` marks
    a dimension of constant size, which is broadcast unconditionally."""
    return df.join(F.broadcast(dim) if fixed_size else dim, on, "inner")


def key_predicate(keys: Iterable[str] | None, known: DataFrame, col: str = "city"):
    """F4 as a predicate (None = all keys): the chosen keys; keys unknown to
    ``known`` are ignored, and a choice with no known key means all keys.
    Whether any is known is one bounded check (at most one row) when the query
    is built; the filter itself is then a plain IN list, which is pushed to the
    scan."""
    chosen = [k for k in (keys or [])]
    if not chosen or known.where(F.col(col).isin(chosen)).isEmpty():
        return None
    return F.col(col).isin(chosen)


def key_filter(df: DataFrame, keys: Iterable[str] | None, known: DataFrame | None = None,
               col: str = "city") -> DataFrame:
    """F4 applied to ``df``."""
    pred = key_predicate(keys, known if known is not None else df, col)
    return df if pred is None else df.where(pred)


def key_equals(df: DataFrame, key: str | Column, col: str = "city") -> DataFrame:
    """single-key filter (literal or scalar-subquery column)."""
    k = key if isinstance(key, Column) else F.lit(key)
    return df.where(F.col(col) == k)


def semi_match(df: DataFrame, keys_df: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key pair occurs in ``keys_df`` (exact pairs)."""
    return df.join(keys_df.select(*on).distinct(), on, "left_semi")
