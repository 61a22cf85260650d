"""Tables survive a job that dies at any point of a replacement."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import msg
from pyspark.sql import functions as F

from aurum import session
from aurum.config import Config
from aurum.functions import parse
from aurum.operators import gold, incremental, merge, silver
from aurum.sources.store import MedallionStore
from aurum.sources.versioned import ConcurrentWrite, NumberedFile, Versioned

DAYS = [dt.date(2026, 6, d) for d in range(20, 26)]


class Killed(Exception):
    pass


def _silver(spark, lake, messages):
    typed = parse.parse_messages(spark.createDataFrame([(m,) for m in messages], "value string"))
    return silver.to_silver(typed, lake.cfg)


def _load(spark, lake, t, hours=(1, 2), days=DAYS):
    rows = _silver(spark, lake, [msg(f"k{k}", event_time=f"{d}T{h:02d}:00", t=t + k)
                                 for d in days for h in hours for k in range(3)])
    incremental.write_silver(lake, rows)
    incremental.refresh_gold(lake, rows)


@pytest.fixture
def lake(spark, tmp_path):
    lake = MedallionStore(spark, f"{tmp_path}/lake", Config(latest_buckets=4)).ensure_tables()
    _load(spark, lake, 10.0)
    return lake


def _all(lake):
    return {n: sorted((tuple(r) for r in lake.read(n).drop("ingested_at").collect()), key=repr)
            for n in ("silver", "latest", "hourly", "daily")}


def _die_before_switch(monkeypatch, folder=""):
    real = NumberedFile.publish

    def publish(self, after, value):
        if folder in self.folder:
            raise Killed
        return real(self, after, value)
    monkeypatch.setattr(NumberedFile, "publish", publish)


@pytest.mark.parametrize("table", ["latest.v", "hourly.v", "daily.v"])
def test_merge_killed_before_the_switch(spark, lake, monkeypatch, table):
    """The killed table is as it was, the others as before or after; a replay repairs all."""
    before = _all(lake)
    rows = _silver(spark, lake, [msg("k1", event_time=f"{d}T05:00", t=55.0) for d in DAYS])
    with monkeypatch.context() as m:
        _die_before_switch(m, table)
        with pytest.raises(Killed):
            incremental.write_silver(lake, rows)
            incremental.refresh_gold(lake, rows)
    assert _all(lake)[table[:-2]] == before[table[:-2]]
    incremental.write_silver(lake, rows)  # the replay
    incremental.refresh_gold(lake, rows)
    merged = _all(lake)
    incremental.rebuild_gold(lake)
    assert _all(lake) == merged != before


def test_merge_killed_while_files_are_written(spark, lake):
    before = _all(lake)
    table = lake.table("daily")
    bad = lake.read("daily").withColumn("avg_temp", F.when(F.col("day") == DAYS[3], F.raise_error(F.lit("lost")))
                                        .otherwise(F.lit(-1.0)))
    with pytest.raises(Exception, match="lost"):
        table.replace(bad, DAYS)
    assert _all(lake) == before


def test_rebuild_killed_half_way(spark, lake, monkeypatch):
    before = _all(lake)
    with monkeypatch.context() as m:
        _die_before_switch(m, "hourly.v")
        with pytest.raises(Killed):
            incremental.rebuild_gold(lake)
    assert _all(lake) == before
    incremental.rebuild_gold(lake)
    assert _all(lake) == before


def test_compaction_killed_appended_to_and_cleaned(spark, lake, monkeypatch):
    _load(spark, lake, 30.0, hours=(7,), days=DAYS[:2])
    before = _all(lake)
    with monkeypatch.context() as m:
        _die_before_switch(m, "silver.v")
        with pytest.raises(Killed):
            lake.compact("silver", DAYS[:2])
    assert _all(lake) == before
    lake.compact("silver", DAYS[:2])
    lake.compact("daily", DAYS)
    assert _all(lake) == before
    assert lake.table("silver").vacuum() == []  # all too young
    assert lake.table("silver").vacuum(0) and lake.table("daily").vacuum(0)
    assert _all(lake) == before
    _load(spark, lake, 31.0, hours=(7, 8), days=DAYS[:1])  # hour 7 is known: the first write stays
    after = _all(lake)
    assert len(after["silver"]) == len(before["silver"]) + 3
    lake.compact("silver", DAYS[:2])
    lake.table("silver").vacuum(0)
    assert _all(lake) == after
    incremental.rebuild_gold(lake)
    assert _all(lake) == after
    assert {r["day"] for r in lake.table("silver").read(DAYS[1:3]).select("day").distinct().collect()} == set(DAYS[1:3])


def test_rebucket_killed(spark, lake, monkeypatch):
    before = _all(lake)
    wider = MedallionStore(spark, lake.root, Config(latest_buckets=32))
    with monkeypatch.context() as m:
        _die_before_switch(m, "latest.v")
        with pytest.raises(Killed):
            wider.rebucket()
    assert _all(wider)["latest"] == before["latest"]
    for store in (lake, wider):  # nobody writes until it has been finished
        with pytest.raises(RuntimeError, match="did not finish"):
            _load(spark, store, 50.0)
    wider.rebucket()
    with pytest.raises(ValueError, match="latest_buckets"):
        _load(spark, lake, 50.0)
    _load(spark, wider, 50.0, hours=(9,))
    assert wider.read("latest").count() == 3


def test_retention_on_versioned_tables(spark, lake):
    lake.compact("silver", DAYS)
    for name in ("silver", "hourly", "daily"):
        assert lake.drop_days_before(name, DAYS[3]) == [str(d) for d in DAYS[:3]]
        assert {r["day"] for r in lake.read(name).collect()} == set(DAYS[3:])
    _load(spark, lake, 40.0, hours=(1, 3))
    assert {r["day"] for r in lake.read("silver").collect()} == set(DAYS[3:])
    assert lake.read("late").count() == 18


def test_layout_is_never_missing(spark, lake, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(session, "write_small", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            lake.drop_days_before("silver", DAYS[1])
    assert lake.silver_from() is None and lake.layout()["latest_buckets"] == 4
    lake.drop_days_before("silver", DAYS[1])
    assert lake.silver_from() == str(DAYS[1])
    session.delete(spark, f"{lake.root}/_layout.d")
    with pytest.raises(RuntimeError, match="no layout"):
        _load(spark, lake, 50.0)


def test_store_of_an_earlier_version(spark, tmp_path, lake):
    """Tables in place and one layout file are read and merged."""
    root = f"{tmp_path}/old"
    for name in ("silver", "latest", "hourly", "daily"):
        lake.read(name).write.partitionBy(lake.partition_col(name)).parquet(f"{root}/{name}")
    session.write_small(spark, f"{root}/_layout", json.dumps({"latest_buckets": 4, "tz": "UTC", "silver_from": None}))
    old = MedallionStore(spark, root, lake.cfg)
    assert _all(old) == _all(lake)
    for store in (old, lake):
        _load(spark, store, 44.0, hours=(2, 23), days=DAYS[2:4])
    assert _all(old) == _all(lake)


def test_two_writers(spark, lake, monkeypatch):
    """The second of two writers that began alike is refused; the first one's rows stay."""
    table, slow = lake.table("daily"), lake.table("daily")
    rows = lake.read("daily")
    state = slow.state()
    monkeypatch.setattr(slow, "state", lambda: state)
    table.replace(rows.where(F.col("city") == "k1"), None)
    with pytest.raises(ConcurrentWrite):
        slow.replace(rows.where(F.col("city") == "k2"), None)
    assert {r["city"] for r in lake.read("daily").collect()} == {"k1"}


def test_reader_that_began_before_a_replacement(spark, lake):
    begun = lake.read("daily")
    want = begun.count()
    _load(spark, lake, 41.0, hours=(20,))
    assert begun.count() == want


def test_replacement_to_no_rows_and_empty_tables(spark, lake):
    lake.table("daily").replace(lake.read("daily").where("false"), DAYS[:2])
    assert {r["day"] for r in lake.read("daily").collect()} == set(DAYS[2:])
    lake.table("daily").replace(lake.read("daily").where("false"), None)
    assert lake.read("daily").count() == 0
    t = Versioned(spark, f"{lake.root}/nowhere", lake.schema("daily"), "day")
    assert t.read(DAYS).count() == 0


def test_repeated_update_keys_are_refused(spark, lake):
    twice = lake.read("daily").unionByName(lake.read("daily"))
    for mode in ("replace", "ignore"):
        with pytest.raises(ValueError, match="2 times"):
            merge.merge_keyed(spark, lake.path("daily"), twice, ["city", "day"], "day", mode, lake.schema("daily"))


def test_catalog_sees_versions(spark, lake):
    lake.register_catalog(database="versioned_test")
    count = lambda n: spark.table(f"versioned_test.{n}").count()
    assert count("daily") == lake.read("daily").count() and count("latest") == 3
    _load(spark, lake, 42.0, hours=(11,), days=[dt.date(2026, 7, 1)])
    lake.compact("silver", DAYS)
    lake.refresh_catalog(database="versioned_test")
    for n in ("silver", "hourly", "daily", "latest"):
        assert count(n) == lake.read(n).count()
    spark.sql("DROP DATABASE versioned_test CASCADE")


def test_manifests_and_replaced_folders_are_bounded(spark, lake, monkeypatch):
    from aurum.sources import versioned
    monkeypatch.setattr(versioned, "KEEP_S", 0)
    table = lake.table("daily")
    for _ in range(14):
        table.replace(table.read(DAYS[:1]), DAYS[:1])
    assert len(table.manifest.numbers()) <= versioned.KEEP_MANIFESTS + 2
    folders = [f"{v}/{f}" for v in session.child_names(spark, table.beside) if v.startswith("ver=")
               for f in session.child_names(spark, f"{table.beside}/{v}") if f.startswith("day=")]
    assert len(folders) <= len(DAYS) + 2
    assert lake.read("daily").count() == 18
