"""Rules (P5, F2) and message decoding (P2-P4, FX4 e1-e10b)."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import messages_df, msg
from pyspark.sql import functions as F

from aurum.config import Config
from aurum.functions import parse, rules, times
from aurum.operators import silver


def _label(spark, code):
    df = spark.createDataFrame([(None if code is None else float(code),)], "c double")
    return df.select(rules.condition_from_code(F.col("c"))).first()[0]


@pytest.mark.parametrize("code,label", [
    (0, "Clear"), (3, "Cloudy"), (61, "Rain"), (95, "Thunderstorm"), (48, "Fog"),
    (57, "Drizzle"), (77, "Snow"), (81, "Rain showers"), (86, "Snow showers"),
    (123, "Unknown"), (None, "Unknown"), (0.7, "Clear"), (3.9, "Cloudy"),
    (float("nan"), "Unknown"), (float("inf"), "Unknown"), (-0.5, "Clear"),
])
def test_code_labels(spark, code, label):
    assert _label(spark, code) == label


def _valid(spark, t, h, w):
    row = tuple(None if v is None else float(v) for v in (t, h, w))
    df = spark.createDataFrame([row], "t double, h double, w double")
    return df.select(F.coalesce(rules.is_valid_reading(F.col("t"), F.col("h"), F.col("w")),
                                F.lit(False))).first()[0]


@pytest.mark.parametrize("t,h,w,ok", [
    (37.6, 32, 2.5, True), (999, 80, 6, False), (33, 250, 8, False), (30, 50, -1, False),
    (-60, 0, 0, True), (60, 100, 0, True),                      # e7 inclusive bounds
    (60.01, 50, 1, False), (-60.01, 50, 1, False), (20, -0.1, 1, False),
    (20, 50, float("nan"), False),                              # e5 NaN wind
    (20, 50, float("inf"), True),                               # e6 infinite wind
    (float("nan"), 50, 1, False), (None, 50, 1, False), (20, None, 1, False),
])
def test_validity_gate(spark, t, h, w, ok):
    assert _valid(spark, t, h, w) is ok


def test_sql_functions(spark):
    rules.register_sql_functions(spark)
    r = spark.sql("SELECT code_to_condition(61.0) AS a, code_to_condition(NULL) AS b, "
                  "is_valid_reading(37.6, 32, 2.5) AS c, is_valid_reading(999, 80, 6) AS d"
                  ).first()
    assert (r.a, r.b, r.c, r.d) == ("Rain", "Unknown", True, False)


def test_malformed_messages(spark):
    bad = ["not json", "{'city':'B'}", '{"city":"D"} trailing', "[1,2]", "123", "null", None]
    good = [msg("A")]
    df = parse.decode_json(messages_df(spark, bad + good))
    flags = {r.src_offset: r.is_malformed for r in df.collect()}
    assert [flags[i] for i in range(len(bad))] == [True] * len(bad)
    assert flags[len(bad)] is False
    assert parse.parse_messages(messages_df(spark, bad + good)).count() == 1


def _typed(spark, values, cfg=Config()):
    return parse.parse_messages(messages_df(spark, values), "value", cfg)


def test_numeric_coercion(spark):
    vals = [msg("q", t="37.6"), msg("abc", t="abc"), msg("d", t="37.6d"),
            '{"city":"nan","event_time":"2026-06-25T12:30","temperature_c":NaN}',
            '{"city":"inf","event_time":"2026-06-25T12:30","temperature_c":Infinity}',
            msg("null", t=None), json.dumps({"city": "absent", "event_time": "2026-06-25T12:30"}),
            msg("qinf", t="Infinity"), msg("exp", t="1e1")]
    got = {r.city: r.temperature_c for r in _typed(spark, vals).collect()}
    assert got["q"] == 37.6                                       # e3
    for c in ("abc", "d", "nan", "inf", "null", "absent"):        # e4
        assert got[c] is None, c
    assert got["qinf"] == float("inf") and got["exp"] == 10.0


@pytest.mark.parametrize("text,expected", [
    ("2026-06-25T12:30", dt.datetime(2026, 6, 25, 12, 30)),
    ("2026-06-25T12:31:00+05:30", dt.datetime(2026, 6, 25, 7, 1)),
    ("2026-06-25T12:30Z", dt.datetime(2026, 6, 25, 12, 30)),      # e10b
    ("2026-06-25T12:30:00+05", dt.datetime(2026, 6, 25, 7, 30)),
    ("2026-06-25T12:30-0530", dt.datetime(2026, 6, 25, 18, 0)),
    ("2026-06-25 12:30:15", dt.datetime(2026, 6, 25, 12, 30, 15)),
    ("2026-06-25", dt.datetime(2026, 6, 25)),
    ("12:30", None), ("2026", None), ("bad", None), (None, None),  # e10
])
def test_event_time_parse(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    got = df.select(times.to_ntz(times.parse_event_time(F.col("s"))).alias("t")).first().t
    assert got == expected


def test_naive_time_in_business_zone(spark):
    df = spark.createDataFrame([("2026-06-25T12:30",), ("2026-06-25T12:30:00+05",)], "s string")
    got = [r[0] for r in df.select(
        times.to_ntz(times.parse_event_time(F.col("s"), "Asia/Kolkata"))).collect()]
    assert got == [dt.datetime(2026, 6, 25, 7, 0), dt.datetime(2026, 6, 25, 7, 30)]


def test_rows_without_key_dropped(spark):
    vals = [msg(None), msg("x", event_time=None), msg("y", event_time="12:30"),
            msg("z", event_time="2026"), msg("ok")]
    out = silver.to_silver(_typed(spark, vals))
    assert [r.city for r in out.collect()] == ["ok"]


def test_api_payload_flatten(spark):
    payload = json.dumps({"current": {"time": "2026-06-25T12:30", "temperature_2m": 30.5,
                                      "relative_humidity_2m": 40, "wind_speed_10m": 3.0,
                                      "weather_code": 2}})
    no_time = json.dumps({"current": {"temperature_2m": 30.5}})
    df = spark.createDataFrame(
        [("Delhi", payload, "2026-06-25T12:31:00+05:30"), ("Mumbai", no_time, "x")],
        "city string, payload string, fetched_at string")
    typed = parse.parse_messages(parse.flatten_api_payload(df)).collect()
    assert len(typed) == 1
    r = typed[0]
    assert (r.city, r.temperature_c, r.humidity_pct, r.condition) == ("Delhi", 30.5, 40.0, "Cloudy")


def test_json_edge_shapes(spark):
    vals = ['{"city":"A","city":"B","event_time":"2026-06-25T12:30","temperature_c":1}',
            '  {"city":"W","event_time":"2026-06-25T12:30","temperature_c":2}\n',
            '{"city":"N","event_time":"2026-06-25T12:30","temperature_c":{"v":3}}',
            '{"city":"X","event_time":"2026-06-25T12:30","temperature_c":4,"extra":[1]}']
    got = {r.city: r.temperature_c for r in _typed(spark, vals).collect()}
    assert got == {"B": 1.0, "W": 2.0, "N": None, "X": 4.0}


def test_one_object_and_nothing_after_it(spark):
    """Text after the object, also of a form that closes what it is read within, is malformed."""
    good = ['{"city": "A"}', ' {"city": "A"}\n', '{}', '{"city": {"a": [1]}, "x": "}"}', '{"city": "] {}"}']
    bad = ['{"city": "A"} {}', '{"city": "A"},{"city": "B"}', '{"city": "A"}] {}', '{"city": "A"},{"city": "B"}] {}',
           '{"city": "A"}}', '[{"city": "A"}]', '{"city": "A"', "{'city': 'A'}", '{"city": "A"} x', "", "1", None,
           '{"city": "A",}', '{"city": "A"}{"city": "B"}']
    df = parse.decode_json(spark.createDataFrame([(v,) for v in good + bad], "value string"))
    got = {r["value"]: r["is_malformed"] for r in df.collect()}
    assert got == {**{v: False for v in good}, **{v: True for v in bad}}
    typed = parse.parse_messages(spark.createDataFrame([(v,) for v in good + bad], "value string"))
    assert typed.count() == len(good)
    payload = '{"current": {"time": "2026-06-25T12:30"}}'
    rows = [("A", v, "x") for v in (payload, payload + " {}", payload + "," + payload, payload + "] {}")]
    flat = parse.flatten_api_payload(spark.createDataFrame(rows, "city string, payload string, fetched_at string"))
    assert flat.count() == 1
