"""Serving queries (V1-V15), key filters (F4) and physical-plan assertions."""

from __future__ import annotations

import datetime as dt

from conftest import SF001, messages_df, msg
from pyspark.sql import functions as F

from aurum import session
from aurum.functions import parse
from aurum.operators import incremental, silver
from aurum.plans import serve
from aurum.plans.tables import Tables, tables_from_events
from aurum.sources.store import MedallionStore


def _tables(spark, values):
    return Tables.from_silver(silver.to_silver(parse.parse_messages(messages_df(spark, values))))


WEATHER = [
    msg("Delhi", event_time="2026-06-25T12:00", t=41.2, code=0),
    msg("Delhi", event_time="2026-06-24T12:00", t=39.0, code=0),
    msg("Mumbai", event_time="2026-06-25T12:00", t=31.0, code=63),
    msg("Chennai", event_time="2026-06-25T11:00", t=31.0, code=95),
    msg("Kolkata", event_time="2025-06-25T12:00", t=20.0, code=150),
]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_filter_semantics(spark):
    t = _tables(spark, WEATHER)
    assert {r.city for r in serve.alerts(t, cities=["Delhi", "Mumbai"]).collect()} == {"Delhi"}
    # unknown keys are ignored; nothing known means all keys
    assert serve.city_latest(t).count() == 4
    from aurum.operators import lookups
    assert lookups.key_filter(t.latest, ["Nowhere"], t.latest).count() == 4
    assert lookups.key_filter(t.latest, ["Nowhere", "Delhi"], t.latest).count() == 1
    assert lookups.key_filter(t.latest, [], t.latest).count() == 4


def test_kpi_row_ties_and_latest_day(spark):
    t = _tables(spark, WEATHER)
    k = serve.kpi_row(t).first()
    assert (k.live_keys, k.hottest_city, k.hottest_temp) == (4, "Delhi", 41.2)
    assert (k.coolest_city, k.coolest_temp) == ("Kolkata", 20.0)
    assert k.heatwave_keys == 1
    k2 = serve.kpi_row(t, cities=["Mumbai", "Chennai"]).first()
    assert (k2.hottest_city, k2.coolest_city, k2.heatwave_keys) == ("Chennai", "Chennai", 0)


def test_cards_emoji_and_order(spark):
    t = _tables(spark, WEATHER)
    rows = serve.ranked_cards(t).collect()
    assert [r.city for r in rows] == ["Delhi", "Chennai", "Mumbai", "Kolkata"]
    emo = {r.city: r.emoji for r in rows}
    assert emo["Delhi"] == "☀️" and emo["Kolkata"] == "❓" and emo["Mumbai"] == "🌧️"


def test_map_points_drops_unknown_keys(spark):
    from aurum.operators import lookups
    t = _tables(spark, WEATHER + [msg("Atlantis", t=10.0)])
    pts = serve.map_points(t, lookups.city_dim(spark), fixed_size=True).collect()
    assert {r.city for r in pts} == {"Delhi", "Mumbai", "Chennai", "Kolkata"}
    assert {r.city: r.lat for r in pts}["Delhi"] == 28.61


def test_recent_window_inclusive(spark):
    t = _tables(spark, WEATHER)
    as_of = dt.datetime(2026, 6, 25, 12, 0)
    got = serve.recent_readings(t, 1, as_of=F.lit(as_of).cast("timestamp"))
    assert sorted(r.city for r in got.collect()) == ["Chennai", "Delhi", "Mumbai"]
    got24 = serve.trend(t, 24, ["Delhi"], as_of=F.lit(as_of).cast("timestamp"))
    assert [r.temperature_c for r in got24.collect()] == [39.0, 41.2]


def test_spotlight_and_latest_full(spark):
    t = _tables(spark, WEATHER)
    r = serve.spotlight(t, serve.hottest_key(t)).collect()
    assert len(r) == 1 and r[0].city == "Delhi" and r[0].wind_speed_kmh == 2.5
    assert serve.spotlight(t, "Mumbai").first().temperature_c == 31.0


def test_daily_labels_and_heatwave_days(spark):
    t = _tables(spark, WEATHER)
    lab = {(r.city, r.day): r.flag for r in serve.daily_flag_labels(t).collect()}
    assert lab[("Delhi", "2026-06-25")] == "Heatwave >40°"
    assert lab[("Delhi", "2026-06-24")] == "Normal"
    assert [r.city for r in serve.heatwave_days(t).collect()] == ["Delhi"]


def test_hour_pivot_years_share_a_label(spark):
    vals = [msg("A", event_time="2025-06-25T12:00", t=10.0),
            msg("A", event_time="2026-06-25T12:10", t=20.0),
            msg("B", event_time="2026-06-25T13:00", t=5.0)]
    t = _tables(spark, vals)
    p = {r.city: r for r in serve.hour_pivot(t).collect()}
    assert p["A"]["06-25 12:00"] == 15.0 and p["A"]["06-25 13:00"] is None   # e19
    fixed = serve.hour_pivot(t, labels=["06-25 12:00"])
    assert fixed.columns == ["city", "06-25 12:00"]


def test_newest_readings_is_top_k(spark):
    t = tables_from_events(spark, SF001)
    df = serve.newest_readings(t, 20)
    assert df.count() == 20
    assert "TakeOrderedAndProject" in _plan(df)


def test_no_python_udfs_and_single_json_parse(spark):
    t = tables_from_events(spark, SF001)
    for df in (t.daily, t.hourly, t.latest, serve.kpi_row(t)):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    plan = t.silver._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_dedup_uses_partial_window_group_limit(spark):
    t = tables_from_events(spark, SF001)
    t.silver.write.format("noop").mode("overwrite").save()
    plan = _plan(t.silver)
    assert "WindowGroupLimit" in plan


def test_stored_tables_prune_partitions_and_broadcast_dims(spark):
    lake = MedallionStore(spark, session.fresh_dir(spark, "plans")).ensure_tables()
    vals = [msg("A", event_time=f"2026-06-{d:02d}T10:00", t=float(d)) for d in range(1, 10)]
    sb = silver.to_silver(parse.parse_messages(messages_df(spark, vals)))
    incremental.write_silver(lake, sb)
    incremental.refresh_gold(lake, sb)
    t = Tables.from_store(lake)
    rec = serve.recent_readings(t, 24, as_of=F.lit(dt.datetime(2026, 6, 9, 12)).cast("timestamp"))
    assert rec.count() == 1
    fs = rec._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in fs and "day#" in fs
    cards = serve.ranked_cards(t)
    cards.collect()
    assert "BroadcastHashJoin" in _plan(cards) or "BroadcastNestedLoopJoin" in _plan(cards)


def test_touched_key_scan_prunes_days_and_fixed_dims_broadcast(spark):
    from aurum.operators import lookups
    lake = MedallionStore(spark, session.fresh_dir(spark, "plans-r4")).ensure_tables()
    vals = [msg(c, event_time=f"2026-06-{d:02d}T10:00") for c in "AB" for d in range(1, 6)]
    sb = silver.to_silver(parse.parse_messages(messages_df(spark, vals)))
    incremental.write_silver(lake, sb)
    batch = sb.where("day = DATE'2026-06-03' AND city = 'A'")
    sub = lake.silver_for_keys(batch, [dt.date(2026, 6, 3)], broadcast=True)
    assert [(r.city, r.day.day) for r in sub.collect()] == [("A", 3)]
    plan = _plan(sub)
    assert "PartitionFilters: [isnotnull(day" in plan and "BroadcastHashJoin" in plan
    t = Tables.from_store(lake)
    pts = serve.map_points(t, lookups.city_dim(spark), fixed_size=True)
    pts.collect()
    assert "BroadcastHashJoin" in _plan(pts)


def test_serving_views_for_sql(spark):
    t = _tables(spark, WEATHER)
    names = serve.register_views(t)
    assert "v_kpi_row" in names and "v_city_latest" in names
    assert spark.sql("SELECT hottest_city FROM v_kpi_row").first()[0] == "Delhi"
    assert spark.sql("SELECT count(*) FROM v_heatwave_days").first()[0] == 1
