"""A bundle of the four serving tables, built lazily from silver or read from
a stored ``MedallionStore``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, Config
from ..functions import parse
from ..operators import gold, silver
from ..sources import events as ev


@dataclass
class Tables:
    silver: DataFrame
    latest: DataFrame
    hourly: DataFrame
    daily: DataFrame
    cfg: Config = DEFAULT

    @classmethod
    def from_silver(cls, silver_df: DataFrame, cfg: Config = DEFAULT) -> Tables:
        return cls(
            silver=silver_df,
            latest=gold.build_latest(silver_df),
            hourly=gold.build_hourly(silver_df, cfg),
            daily=gold.build_daily(silver_df, cfg),
            cfg=cfg,
        )

    @classmethod
    def from_store(cls, lake) -> Tables:
        return cls(silver=lake.read("silver"), latest=lake.read("latest"),
                   hourly=lake.read("hourly"), daily=lake.read("daily"), cfg=lake.cfg)


def typed_events(spark: SparkSession, sf_dir: str, cfg: Config = DEFAULT) -> DataFrame:
    """events -> JSON messages -> decoded, typed rows (the full parse path)."""
    msgs = ev.events_as_messages(ev.read_table(spark, sf_dir, "events"))
    return parse.parse_messages(msgs, "value", cfg)


def silver_from_events(spark: SparkSession, sf_dir: str, cfg: Config = DEFAULT) -> DataFrame:
    return silver.to_silver(typed_events(spark, sf_dir, cfg), cfg)


def tables_from_events(spark: SparkSession, sf_dir: str, cfg: Config = DEFAULT) -> Tables:
    return Tables.from_silver(silver_from_events(spark, sf_dir, cfg), cfg)
