"""Driver contract: entry smoke, registry coverage, Spark vs DuckDB at sf0.001."""

from __future__ import annotations

import math
import os

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as E

READ_ONLY = [n for n in E.registry.QUERIES if n not in {
    "insert_if_absent", "upsert_replace", "upsert_if_newer", "incremental_gold",
    "incremental_latest_hourly", "stream_medallion", "stream_bronze_counts", "stream_tiers",
    "stream_run_log", "stream_late_files", "retention_late",
    "rebuild_gold", "retention", "repair_pairs", "stream_arrival_order",
    "stream_tiers_run_log", "bronze_life_cycle", "backfill_ranges"}]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["city", "day", "avg_temp", "max_temp", "min_temp", "readings",
                          "heatwave"]


def test_every_query_has_an_oracle():
    assert set(E.registry.QUERIES) == set(E.registry.ORACLES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split():
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return "∅" if v is None else str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", READ_ONLY)
def test_query_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, rows) == _bag(ocols, res.fetchall())
