"""The physical plans are the ones intended: filters reach the scans,
scans read only used columns, identity has no window, shard ranges prune
partitions of a real suffix-partitioned dataset."""

from pyspark.sql import functions as F

from folders import SF_SMALL
from lifeline.config import SyncConfig
from lifeline.operators.identity import first_touch
from lifeline.plans import events_job, state_job
from lifeline.sources.inputs import load_testdata
from lifeline.sources.shards import ShardedEvents

CFG = SyncConfig()


def plan(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_day_filter_is_pushed_to_the_scan(spark):
    p = plan(events_job.day_events(load_testdata(spark, SF_SMALL), CFG))
    assert "GreaterThanOrEqual(ts,2024-01-29T23:00)" in p
    assert "LessThan(ts,2024-01-30T23:00)" in p


def test_state_scan_reads_only_used_columns(spark):
    p = plan(state_job.state_rows(load_testdata(spark, SF_SMALL), CFG))
    scans = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert scans and all("o_totalprice" not in s and "o_orderdate" not in s for s in scans)


def test_identity_is_an_aggregate_without_windows(spark):
    p = plan(first_touch(load_testdata(spark, SF_SMALL).analytics.all(), CFG))
    assert "Window" not in p
    assert "partial_min" in p  # map-side combine before the exchange


def test_event_identity_uses_broadcast_key_filter(spark):
    p = plan(events_job.events_with_identity(load_testdata(spark, SF_SMALL), CFG))
    assert "LeftSemi" in p and "BroadcastExchange" in p


def test_shard_range_prunes_partitions(spark, tmp_path):
    derived = load_testdata(spark, SF_SMALL).analytics
    path = str(tmp_path / "analytics")
    derived.write(path)
    stored = ShardedEvents.read(spark, path)
    assert dict(stored.df.dtypes)["suffix"] == "string"
    df = stored.between(*CFG.state_shard_range)
    p = plan(df)
    assert "PartitionFilters" in p and "20240130" in p
    cols = ["event_id", "user_id", "user_pseudo_id", "event_timestamp", "suffix"]
    a = df.select(*cols, F.col("app_info.firebase_app_id"))
    b = derived.between(*CFG.state_shard_range).select(*cols, F.col("app_info.firebase_app_id"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_snapshot_lookback_prunes_day_partitions(spark, tmp_path):
    """Production layout: snapshot partitioned by calendar_date; the
    lookback bound of the latest entry prunes partitions on both sides of
    the self-join, and the result equals the unpartitioned one."""
    from lifeline.operators import state
    from lifeline.sources.inputs import Inputs

    inp = load_testdata(spark, SF_SMALL)
    inp.snapshot.write.partitionBy("calendar_date").parquet(str(tmp_path / "snap"))
    inp.subscription_events.write.parquet(str(tmp_path / "subs"))
    inp.analytics.write(str(tmp_path / "analytics"))
    stored = Inputs.read(spark, str(tmp_path / "snap"), str(tmp_path / "subs"), str(tmp_path / "analytics"))
    latest = state.latest_entry(stored.snapshot, CFG)
    p = plan(latest)
    pruned = [line for line in p.splitlines() if line.startswith("PartitionFilters")]
    assert len(pruned) >= 2 and all("calendar_date" in line and "2024-01-24" in line for line in pruned)
    base = state.latest_entry(inp.snapshot, CFG)
    got = latest.select(*base.columns)
    assert got.exceptAll(base).count() == 0 and base.exceptAll(got).count() == 0


def test_zoned_stored_timestamps_read_as_utc_wall_with_pushdown(spark, tmp_path):
    """Facts stored with zoned timestamps: the declared ntz schema reads
    their UTC wall time whatever the session zone, and the day filter of the
    event job still reaches the scan."""
    import datetime as dt

    from lifeline.operators.events import events_of_day
    from lifeline.sources.schemas import SUBSCRIPTION_EVENT_SCHEMA

    utc = dt.timezone.utc
    df = spark.createDataFrame(
        [(1, "7", "Renewal", dt.datetime(2024, 1, 29, 23, 30, tzinfo=utc), "S1", "x"),
         (2, "7", "Renewal", dt.datetime(2024, 1, 29, 22, 30, tzinfo=utc), "S1", "y")],
        "event_id long, user_id string, event_type string, event_ts timestamp, "
        "subscription_id string, offer_type string")
    df.write.parquet(str(tmp_path / "ltz"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        stored = spark.read.schema(SUBSCRIPTION_EVENT_SCHEMA).parquet(str(tmp_path / "ltz"))
        day = events_of_day(stored, CFG)
        assert [r.offer_type for r in day.collect()] == ["x"]  # 00:30 Berlin on the 30th
        assert "GreaterThanOrEqual(event_ts,2024-01-29T23:00)" in plan(day)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_frames_with_zoned_timestamps_are_conformed(spark):
    """Frames handed over with zoned timestamps (any session zone) give the
    same state and event rows as the bound tables."""
    from lifeline.plans import events_job, state_job
    from lifeline.sources.inputs import Inputs

    inp = load_testdata(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        def zoned(df, col):
            # UTC wall time -> Tokyo wall time -> zoned instant (session zone is Tokyo)
            tokyo = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Tokyo"), F.col(col))
            return df.withColumn(col, tokyo.cast("timestamp")).withColumn("extra", F.lit(1))
        snap = zoned(inp.snapshot, "subscription_cancel_dts")
        subs = zoned(inp.subscription_events, "event_ts")
        ana = zoned(inp.analytics.all(), "event_timestamp")
        assert dict(subs.dtypes)["event_ts"] == "timestamp"
        framed = Inputs.from_frames(snap, subs, ana)
        assert dict(framed.subscription_events.dtypes)["event_ts"] == "timestamp_ntz"
        for a, b in ((state_job.state_with_identity(framed, CFG), state_job.state_with_identity(inp, CFG)),
                     (events_job.event_rows(framed, CFG), events_job.event_rows(inp, CFG))):
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_churn_rollup_folds_by_hash(spark):
    """Fixed-width maxima: no sort of raw snapshot rows."""
    from lifeline.operators import state

    text = state.churn_rollup(load_testdata(spark, SF_SMALL).snapshot, CFG)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_event_fact_is_scanned_once_by_partition(spark, tmp_path):
    """Events stored by UTC day: the local day reads two folders, and what
    follows reads the checkpointed day; same rows as the flat layout."""
    from lifeline.sources.inputs import Inputs

    inp = load_testdata(spark, SF_SMALL)
    snap, subs, ana = (str(tmp_path / n) for n in ("snap", "subs", "ana"))
    inp.snapshot.write.parquet(snap)
    inp.subscription_events.withColumn("event_day", F.to_date("event_ts")).write.partitionBy("event_day").parquet(subs)
    inp.analytics.write(ana)
    stored = Inputs.read(spark, snap, subs, ana, events_by_day=True)
    assert "PartitionFilters: [isnotnull(event_day" in plan(events_job.day_events(stored, CFG))
    rows = events_job.event_rows(stored, CFG)
    assert "event_ts" not in plan(rows)
    flat = events_job.event_rows(inp, CFG)
    assert rows.count() > 0 and rows.exceptAll(flat).count() == 0 and flat.exceptAll(rows).count() == 0


def test_identity_folds_raw_events_by_hash(spark):
    """No sort below the first shuffle: raw events meet a hash aggregate with a fixed-width minimum."""
    shown = plan(first_touch(load_testdata(spark, SF_SMALL).analytics.all(), CFG))
    below = shown[: shown.index("\n\n\n")] if "\n\n\n" in shown else shown
    tree = [line for line in below.splitlines() if "Aggregate" in line or "Exchange" in line or "Sort" in line]
    lowest = [line for line in tree if "Exchange" in line][-1]
    assert not any("Sort" in line for line in tree[tree.index(lowest) :])
    assert any("HashAggregate" in line for line in tree[tree.index(lowest) :])


def test_key_filter_stays_at_any_number_of_keys(spark):
    import dataclasses

    few = dataclasses.replace(CFG, identity_filter_bits=0)
    p = plan(events_job.events_with_identity(load_testdata(spark, SF_SMALL), few))
    assert "LeftSemi" in p and "bitmap_construct_agg" in p
