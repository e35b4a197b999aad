"""Micro goldens for the state query: each status arm, arm order, ties,
churn rollup rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lifeline import config as C
from lifeline.config import SyncConfig
from lifeline.operators import state
from lifeline.sources.schemas import SNAPSHOT_SCHEMA

CFG = SyncConfig()
TODAY = CFG.today_local  # 2024-01-31 (same day in UTC)
D = lambda n: TODAY + dt.timedelta(days=n)


def row(user, cal, group="paying", start=dt.date(2023, 6, 1), cancel=None,
        bcs=dt.date(2024, 1, 1), bce=dt.date(2024, 2, 1), churn_type=None):
    return (user, cal, group, start, cancel, bcs, bce, churn_type, 1, None, None)


def status_of(spark, rows, user="u1"):
    df = spark.createDataFrame(rows, SNAPSHOT_SCHEMA)
    out = state.subscription_state(df, CFG).where(F.col("user_id") == user).collect()
    return sorted(r.subscription_status for r in out)


def test_voluntary_past(spark):
    rows = [row("u1", D(-1), bce=D(-1)),
            row("u1", D(-2), group="churn", bce=D(-1), churn_type="voluntary")]
    assert status_of(spark, rows) == [C.STATUS_CHURN_VOLUNTARY]


def test_involuntary_past_uses_calendar_day(spark):
    # involuntary: end = max calendar day of the churn rows (D(-2)), not cycle end
    rows = [row("u1", D(-1), bce=D(5)),
            row("u1", D(-2), group="churn", bce=D(5), churn_type="involuntary")]
    df = spark.createDataFrame(rows, SNAPSHOT_SCHEMA)
    # the join needs churn end >= start and equal cycle ends; the latest row's
    # day D(-1) is after the churn end D(-2), so the filter drops it
    assert state.subscription_state(df, CFG).count() == 0
    # arm 2 comes before the stale-snapshot arm
    rows = [row("u1", D(-3), bce=D(5)),
            row("u1", D(-2), group="churn", bce=D(5), churn_type="involuntary")]
    assert status_of(spark, rows) == [C.STATUS_CHURN_INVOLUNTARY]
    rows = [row("u1", D(-1), bce=D(5)),
            row("u1", D(-1), group="churn", bce=D(5), churn_type="involuntary")]
    assert status_of(spark, rows) == [C.STATUS_CHURN_INVOLUNTARY]


def test_stale_snapshot_is_churn_unknown(spark):
    assert status_of(spark, [row("u1", D(-2))]) == [C.STATUS_CHURN_UNKNOWN]


def test_cancelled_running(spark):
    cancel = dt.datetime.combine(D(-1), dt.time(9))
    assert status_of(spark, [row("u1", D(-1), cancel=cancel)]) == [C.STATUS_IN_CANCELATION]


def test_plain_active(spark):
    assert status_of(spark, [row("u1", D(-1))]) == [C.STATUS_ACTIVE]


def test_typeless_churn_is_unknown(spark):
    rows = [row("u1", D(-1), bce=D(-1)),
            row("u1", D(-1), group="churn", bce=D(-1), churn_type=None)]
    assert status_of(spark, rows) == [C.STATUS_UNKNOWN]


def test_arm_order_voluntary_beats_stale(spark):
    rows = [row("u1", D(-4), bce=D(-3)),
            row("u1", D(-4), group="churn", bce=D(-3), churn_type="voluntary")]
    assert status_of(spark, rows) == [C.STATUS_CHURN_VOLUNTARY]


def test_both_churn_types_take_voluntary(spark):
    rows = [row("u1", D(-1), group="churn", bce=D(-3), churn_type="involuntary"),
            row("u1", D(-2), group="churn", bce=D(-3), churn_type="voluntary")]
    df = spark.createDataFrame(rows, SNAPSHOT_SCHEMA)
    r = state.churn_rollup(df, CFG).collect()
    assert len(r) == 1 and r[0].churn_type == "voluntary"
    # involuntary arm only applies to involuntary rows: voluntary row uses cycle end
    assert r[0].subscription_end_date == max(D(-1), D(-3))


def test_tie_on_latest_day_keeps_both(spark):
    rows = [row("u1", D(-1), start=dt.date(2023, 1, 1)), row("u1", D(-1), start=dt.date(2023, 2, 1))]
    df = spark.createDataFrame(rows, SNAPSHOT_SCHEMA)
    assert state.latest_entry(df, CFG).count() == 2
    assert len(status_of(spark, rows)) == 2


def test_test_users_and_null_ids_dropped(spark):
    rows = [row("dummy1", D(-1)), row(None, D(-1)), row("u1", D(-1))]
    df = spark.createDataFrame(rows, SNAPSHOT_SCHEMA)
    assert [r.user_id for r in state.subscription_state(df, CFG).collect()] == ["u1"]


def test_lookback_bounds_latest(spark):
    rows = [row("u1", D(-8)), row("u2", D(-7))]
    df = spark.createDataFrame(rows, SNAPSHOT_SCHEMA)
    assert [r.user_id for r in state.latest_entry(df, CFG).collect()] == ["u2"]


def test_dead_or_arm_changes_nothing(spark):
    from folders import SF_MID
    from lifeline.sources.inputs import load_testdata

    snap = state.exclude_test_users(load_testdata(spark, SF_MID).snapshot, CFG)
    latest = state.latest_entry(snap.select(*state.SB_COLUMNS), CFG)
    churn = state.churn_rollup(snap, CFG)
    a = state.snapshot_with_churn(latest, churn, simplified=False)
    b = state.snapshot_with_churn(latest, churn, simplified=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_two_clocks_at_the_midnight_gap(spark):
    """23:30 UTC on the 30th is already the 31st in Berlin: the churn arms
    compare with the UTC day, the others with the local day."""
    cfg = SyncConfig(as_of=dt.datetime(2024, 1, 30, 23, 30, tzinfo=dt.timezone.utc))
    assert (cfg.today_utc, cfg.today_local) == (dt.date(2024, 1, 30), dt.date(2024, 1, 31))
    jan30 = dt.date(2024, 1, 30)
    rows = [row("u1", jan30, bce=jan30),
            row("u1", jan30, group="churn", bce=jan30, churn_type="voluntary")]
    df = spark.createDataFrame(rows, SNAPSHOT_SCHEMA)
    got = [r.subscription_status for r in state.subscription_state(df, cfg).collect()]
    # end (30th) is not before the UTC day (30th): not churned yet by arm 1;
    # not stale (local day - 1 = 30th); end before the local day: not active
    assert got == [C.STATUS_UNKNOWN]
    one_clock = SyncConfig(as_of=dt.datetime(2024, 1, 31, 12, tzinfo=dt.timezone.utc))
    got = [r.subscription_status for r in state.subscription_state(df, one_clock).collect()]
    assert got == [C.STATUS_CHURN_VOLUNTARY]


def test_config_validation():
    import pytest

    with pytest.raises(ValueError):
        SyncConfig(as_of=dt.datetime(2024, 1, 31))  # naive instant
    with pytest.raises(ValueError):
        SyncConfig(routes=C.DEFAULT_ROUTES[:-1])  # no default route last
    cfg = SyncConfig()
    assert cfg.state_shard_range == ("20240130", "20240131")
    assert cfg.events_shard_range == (None, "20240131")
    assert SyncConfig(events_identity_days=3).events_shard_range == ("20240129", "20240131")


def test_later_rows_change_nothing_for_a_past_day(spark):
    from folders import SF_MID
    from lifeline.plans.registry import PAST
    from lifeline.sources.inputs import load_testdata

    snap = load_testdata(spark, SF_MID).snapshot
    cut = snap.where(F.col("calendar_date") <= F.lit(PAST.today_local))
    assert cut.count() < snap.count()
    a, b = (state.subscription_state(x, PAST) for x in (snap, cut))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stored_churn_state_folds_new_days(spark):
    """A stored state of the older days, overlapping or not, gives the whole rollup."""
    from lifeline.plans import registry

    snap = registry._inputs(spark, "/root/testdata/sf0.001").snapshot
    whole = sorted(map(str, state.churn_rollup(snap, CFG).collect()))
    for back in (0, 2, 30):
        end = CFG.today_local - dt.timedelta(days=back)
        older = state.churn_state(snap, CFG, through=end)
        assert sorted(map(str, state.churn_rollup(snap, CFG, older, end).collect())) == whole
        assert sorted(map(str, state.churn_rollup(snap, CFG, state.merge_churn(older, older), end).collect())) == whole
    with pytest.raises(ValueError, match="end by today"):
        state.churn_rollup(snap, CFG, older, CFG.today_local + dt.timedelta(days=1))


def test_other_churn_types_are_kept(spark):
    df = spark.createDataFrame([row("u1", D(-1), group="churn", bce=D(-3), churn_type="other")], SNAPSHOT_SCHEMA)
    assert [r.churn_type for r in state.churn_rollup(df, CFG).collect()] == ["other"]
