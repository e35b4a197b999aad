"""The bucketed identity store: updates write deltas, compaction keeps the state, lookups shuffle users only."""

import dataclasses

import pytest
from folders import SF_SMALL
from pyspark.sql import functions as F
from test_incremental import _add_late_event, _rows
from test_plans import plan

from lifeline.config import SyncConfig
from lifeline.operators import identity_store
from lifeline.operators.identity import first_touch_state
from lifeline.operators.identity_store import IdentityStore
from lifeline.plans import daily, registry
from lifeline.sources.inputs import load_testdata
from lifeline.sources.shards import ShardedEvents

CFG = SyncConfig()


@pytest.fixture
def analytics_path(spark, tmp_path):
    path = str(tmp_path / "analytics")
    load_testdata(spark, SF_SMALL).analytics.write(path)
    return path


@pytest.mark.parametrize("share", [0.0, 10.0], ids=["compacting", "deltas"])
def test_updates_equal_a_fold_of_all_shards(spark, tmp_path, analytics_path, monkeypatch, share):
    monkeypatch.setattr(identity_store, "COMPACT_SHARE", share)
    read = lambda: ShardedEvents.read(spark, analytics_path)
    store = IdentityStore.create(spark, str(tmp_path / "store"), read(), "20240110", buckets=4)
    assert store.update(read(), "20240112") == ["20240111", "20240112"]
    assert store.update(read(), "20240112") == []
    _add_late_event(spark, analytics_path, "20240105")
    before = store.current()
    assert store.update(read(), "20240113") == ["20240105", "20240113"]
    now = store.current()
    assert (now.base == before.base) == (share > 1), "the base is written again only by a compaction"
    assert now.through == "20240113" and now.delta_rows == (0 if share == 0 else store._read(now.delta, 4).count())
    want = first_touch_state(read().between(None, "20240113"))
    assert _rows(store.state()) == _rows(want)
    users = want.select("user_id").where(F.crc32(F.col("user_id").cast("binary")) % 2 == 0)
    asked = users.union(spark.createDataFrame([("nobody",), (None,)], "user_id string"))
    assert _rows(store.lookup(asked)) == _rows(want.join(users, "user_id", "left_semi").select(want.columns))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lifeline_") and not t.isTemporary]


def test_lookups_move_users_only(spark, tmp_path, analytics_path):
    store = IdentityStore.create(spark, str(tmp_path / "store"), ShardedEvents.read(spark, analytics_path), "20240110", buckets=8)
    store.update(ShardedEvents.read(spark, analytics_path), "20240111")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(store.lookup(spark.range(50).select(F.col("id").cast("string").alias("user_id"))))
        merged = plan(store.state())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    tree = shown.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and tree.count("Scan parquet") == 2
    above = [line for line in tree.splitlines() if "Exchange" in line or "Scan" in line]
    assert "Exchange" in above[0] and "Range" not in above[0]
    assert "Exchange" not in merged.split("\n\n")[0]
    assert shown.count("Bucketed: true") == 2


def test_event_sync_with_a_store(spark, tmp_path, analytics_path):
    inputs = dataclasses.replace(load_testdata(spark, SF_SMALL), analytics=ShardedEvents.read(spark, analytics_path))
    store = IdentityStore.create(spark, str(tmp_path / "store"), inputs.analytics, "20240120")
    res = daily.run_events_sync(spark, inputs, CFG, str(tmp_path / "run"), identity_store=store)
    plain = registry.q_batch_json_events(spark, SF_SMALL)
    got = res.batches.select("app_id", res.batches.bucket.cast("long").alias("bucket"), "n_payloads", "payload_array")
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    assert store.current().through == "20240130"
