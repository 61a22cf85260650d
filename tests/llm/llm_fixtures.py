"""Fixtures of the training-data operators (the session is the library's)."""

from __future__ import annotations

import pytest
from helpers import SCHEMA, edge_docs


@pytest.fixture(scope="session")
def edge(spark):
    """The edge-case documents, with further columns whose names clash."""
    from aurum.llm.common import ship
    from pyspark.sql import functions as F
    ship(spark)
    df = spark.createDataFrame(edge_docs(), SCHEMA).repartition(3)
    for name in ("name", "rank", "h", "key", "pos", "level", "kept", "fp", "slot", "start", "length", "rid", "n"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    from aurum.llm.common import ship
    return ship(spark).createDataFrame([], SCHEMA)
