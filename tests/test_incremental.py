"""Runs that carry on what earlier ones kept: latest entries, churn, and identity with late events."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from folders import SF_SMALL
from pyspark.sql import functions as F
from test_plans import plan

from lifeline.config import SyncConfig
from lifeline.operators import state
from lifeline.operators.identity import first_touch_state, read_day_states
from lifeline.plans import daily, state_job
from lifeline.sources.inputs import load_testdata
from lifeline.sources.shards import ShardedEvents, changed_shards

CFG = SyncConfig()
SCHEMA = (
    "user_id string, calendar_date date, base_group string, subscription_start_date date, subscription_cancel_dts timestamp_ntz, "
    "billing_cycle_start_date date, billing_cycle_end_date date, churn_type string"
)


def _rows(df):
    return sorted(map(repr, df.collect()))


def _day(k):
    return CFG.today_local - dt.timedelta(days=k)


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_entries_carried_on_day_by_day(spark, seed):
    """Ties, users who stop paying, days without rows, days left out: as from scratch."""
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, *(f"u{k}" for k in range(25))]), _day(rng.choice(range(14))), rng.choice(["paying", "trial", "churn", None]),
         _day(100), None, None, _day(rng.randint(0, 3)), rng.choice([None, "voluntary"]))
        for _ in range(250)
    ]
    snapshot = spark.createDataFrame(rows, SCHEMA).repartition(4).cache()
    kept, through = state.latest_entry(snapshot, CFG, through=_day(9)), _day(9)
    for back in (8, 7, 4, 4, 1, 0):
        kept = spark.createDataFrame(state.latest_entry(snapshot, CFG, kept, through, _day(back)).collect(), SCHEMA)
        through = _day(back)
        assert _rows(kept) == _rows(state.latest_entry(snapshot, CFG, through=through))
    with pytest.raises(ValueError, match="end by"):
        state.latest_entry(snapshot, CFG, kept, _day(0), _day(1))


def test_carrying_on_reads_the_new_day_only(spark, tmp_path):
    snapshot = load_testdata(spark, SF_SMALL).snapshot
    snapshot.write.partitionBy("calendar_date").parquet(str(tmp_path / "snap"))
    stored = spark.read.parquet(str(tmp_path / "snap")).select(snapshot.columns)
    state.latest_entry(stored, CFG, through=CFG.yesterday_local).write.parquet(str(tmp_path / "latest"))
    older = spark.read.parquet(str(tmp_path / "latest"))
    got = state.latest_entry(stored, CFG, older, CFG.yesterday_local)
    assert _rows(got) == _rows(state.latest_entry(stored, CFG))
    scans = [line for line in plan(got).splitlines() if line.startswith("PartitionFilters") and "calendar_date" in line]
    assert scans and all("2024-01-31" in line and "2024-01-24" not in line for line in scans)


def test_state_sync_keeps_the_snapshot_states(spark, tmp_path):
    """Three runs: each carries on what the last one kept, and sends what a run from scratch sends."""
    inputs = load_testdata(spark, SF_SMALL)
    kept = None
    for back in (2, 1, 0):
        cfg = replace(CFG, as_of=CFG.as_of - dt.timedelta(days=back))
        path = str(tmp_path / f"kept{back}")
        res = daily.run_state_sync(spark, inputs, cfg, str(tmp_path / f"run{back}"), kept=kept, new_kept_path=path)
        plain = state_job.state_batches(inputs, cfg)
        assert _rows(res.batches.select("app_id", "payload_array")) == _rows(plain.select("app_id", "payload_array"))
        kept = state_job.SnapshotStates.read(spark, path, cfg.yesterday_local)


@pytest.fixture
def stored_analytics(spark, tmp_path):
    path = str(tmp_path / "analytics")
    load_testdata(spark, SF_SMALL).analytics.write(path)
    return path


def _add_late_event(spark, path, suffix="20240105"):
    """An event of a new user and an early one of a known user, in an old shard."""
    rows = spark.read.parquet(path).where(F.col("suffix") == suffix).limit(1)
    late = rows.select(
        F.lit(-7).cast("long").alias("event_id"), "user_id", F.lit("LATE").alias("user_pseudo_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("event_timestamp"), "app_info",
    )
    late = late.union(late.withColumn("user_id", F.lit("new-user")))
    late.write.mode("append").parquet(f"{path}/suffix={suffix}")


def test_a_late_event_changes_the_next_run(spark, tmp_path, stored_analytics):
    analytics = lambda: ShardedEvents.read(spark, stored_analytics)
    inputs = load_testdata(spark, SF_SMALL)
    before = replace(CFG, as_of=CFG.as_of - dt.timedelta(days=1))
    v1, v2, days = (str(tmp_path / n) for n in ("v1", "v2", "days"))
    daily.run_events_sync(spark, replace(inputs, analytics=analytics()), before, str(tmp_path / "e1"), new_identity_state_path=v1)
    daily.run_state_sync(spark, replace(inputs, analytics=analytics()), before, str(tmp_path / "s1"), day_states_path=days)
    old_files = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "days").glob("suffix=*/*.parquet")}
    _add_late_event(spark, stored_analytics)

    late = analytics()
    assert changed_shards(daily._read_fingerprints(spark, v1), late.fingerprints("20240130")) == ["20240105", "20240130"]
    daily.run_events_sync(
        spark, replace(inputs, analytics=late), CFG, str(tmp_path / "e2"), identity_state_path=v1, state_through="20240129", new_identity_state_path=v2
    )
    state_now = spark.read.parquet(v2)
    assert _rows(state_now) == _rows(first_touch_state(late.between(None, "20240130")))
    assert state_now.where("first_client.value = 'LATE'").count() == 2
    assert spark.read.parquet(v1).where("first_client.value = 'LATE'").count() == 0

    daily.run_state_sync(spark, replace(inputs, analytics=late), CFG, str(tmp_path / "s2"), day_states_path=days)
    assert read_day_states(spark, days).where("suffix = '20240105' and user_id = 'new-user'").count() == 1
    kept_files = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "days").glob("suffix=*/*.parquet")}
    untouched = {n for n in old_files if kept_files.get(n) == old_files[n]}
    assert len(old_files) - len(untouched) == 1, "only the changed shard's folder is written again"


def test_other_shards_are_not_read(spark, stored_analytics):
    shown = plan(first_touch_state(ShardedEvents.read(spark, stored_analytics).only(["20240105"])))
    assert "PartitionFilters" in shown and "20240105" in shown
    prints = plan(ShardedEvents.read(spark, stored_analytics).fingerprints("20240131"))
    assert "ReadSchema: struct<>" in prints, "fingerprints read no column"


def test_fingerprints_name_what_changed(spark, stored_analytics):
    analytics = ShardedEvents.read(spark, stored_analytics)
    taken = analytics.fingerprints("20240131")
    first = spark.createDataFrame(taken.collect(), taken.schema)
    assert changed_shards(first, ShardedEvents.read(spark, stored_analytics).fingerprints("20240131")) == []
    assert len(changed_shards(None, first)) == first.count() == 30
    _add_late_event(spark, stored_analytics, "20240110")
    assert changed_shards(first, ShardedEvents.read(spark, stored_analytics).fingerprints("20240131")) == ["20240110"]
    assert ShardedEvents.read(spark, stored_analytics).only([]).count() == 0
