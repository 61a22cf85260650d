"""Shared fixtures: one local session, FX2 messages, message builders."""

from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aurum.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_session("local[4]", "aurum-tests", shuffle_partitions=4)
    # tests own their scratch folder; on a cluster it comes from the session
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s


def msg(city="Gurugram", event_time="2026-06-25T12:30", t=37.6, h=32, w=2.5, code=0,
        fetched="2026-06-25T12:31:00+05:30", **extra):
    d = {"city": city, "event_time": event_time, "temperature_c": t, "humidity_pct": h,
         "wind_speed_kmh": w, "weather_code": code, "fetched_at": fetched}
    d.update(extra)
    return json.dumps(d)


# FX2: the six-row dirty batch
FX2 = [
    msg("Gurugram", t=37.6, h=32, w=2.5, code=0),
    msg("Mumbai", t=31.0, h=70, w=12.0, code=3),
    msg("Delhi", t=41.2, h=20, w=5.0, code=0),
    msg("Gurugram", t=37.6, h=32, w=2.5, code=0, fetched="2026-06-25T12:31:30+05:30"),
    msg("Chennai", t=33.0, h=250, w=8.0, code=61),
    msg("Kolkata", t=999.0, h=80, w=6.0, code=95),
]


def messages_df(spark, values, with_offset=True):
    rows = [(v, i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "value string, src_offset bigint")
    return df if with_offset else df.drop("src_offset")


@pytest.fixture
def fx2(spark):
    return messages_df(spark, FX2)
