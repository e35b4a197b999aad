"""The scalable forms against the original query shapes (brute force)."""

import random

import pytest
from pyspark.sql import functions as F

from folders import SF_MID
from literal_forms import identity_by_windows, latest_by_rank, ntile_window
from lifeline.config import SyncConfig
from lifeline.operators import batching, state
from lifeline.operators.identity import first_touch
from lifeline.sources.inputs import load_testdata

CFG = SyncConfig()


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_identity_aggregate_equals_windows(spark):
    analytics = load_testdata(spark, SF_MID).analytics.all()
    assert same(first_touch(analytics, CFG), identity_by_windows(analytics, CFG))


def test_identity_with_broadcast_keys(spark):
    inp = load_testdata(spark, SF_MID)
    analytics = inp.analytics.all()
    keys = analytics.select("user_id").distinct().orderBy("user_id").limit(20)
    got = first_touch(analytics, CFG, keys=keys)
    want = first_touch(analytics, CFG).join(keys, "user_id", "left_semi")
    assert same(got, want)


def test_latest_entry_join_equals_rank(spark):
    snap = load_testdata(spark, SF_MID).snapshot
    from lifeline.operators.state import lookback_start

    assert same(state.latest_entry(snap, CFG), latest_by_rank(snap, CFG, lookback_start(CFG)))


@pytest.mark.parametrize("n_rows,n_groups,target,parts", [
    (1000, 3, 29, 7), (37, 2, 29, 4), (10, 4, 29, 8), (2000, 1, 13, 16), (500, 5, 4, 3),
])
def test_distributed_ntile_equals_window(spark, n_rows, n_groups, target, parts):
    rnd = random.Random(n_rows * 31 + n_groups)
    rows = [
        (f"g{rnd.randrange(n_groups) if rnd.random() > 0.4 else 0}", f"k{i:06d}", rnd.random())
        for i in range(n_rows)
    ]
    df = spark.createDataFrame(rows, "g string, k string, v double")
    got = batching.distributed_ntile(df, "g", ["k"], target, parts).select("g", "k", "v", "bucket")
    n = spark.createDataFrame([(n_rows,)], "n long").select(
        batching.bucket_count(F.col("n"), target).alias("b")).first().b
    want = ntile_window(df, "g", ["k"], int(n)).select("g", "k", "v", "bucket")
    assert same(got, want)
    # the adaptive entry point, both paths
    small = batching.ntile(df, "g", ["k"], target, rows_per_partition=n_rows)
    assert same(small.select("g", "k", "v", "bucket"), want)
    big = batching.ntile(df, "g", ["k"], target, rows_per_partition=max(1, n_rows // 5))
    assert same(big.select("g", "k", "v", "bucket"), want)


@pytest.mark.parametrize("n,expected", [(0, 1), (14, 1), (15, 1), (43, 1), (44, 2), (58, 2), (73, 3)])
def test_bucket_count(spark, n, expected):
    got = spark.createDataFrame([(n,)], "n long").select(
        batching.bucket_count(F.col("n"), 29).alias("b")).first().b
    assert got == expected


def test_bucket_count_half_even(spark):
    # even target: exact halves round to even, as Python's round does
    for n in range(0, 200):
        got = spark.createDataFrame([(n,)], "n long").select(
            batching.bucket_count(F.col("n"), 10).alias("b")).first().b
        assert got == max(1, round(n / 10)), n


def test_identity_state_folds_exactly(spark, tmp_path):
    from lifeline.operators.identity import (
        finalize_first_touch, first_touch_state, fold_shards, write_state)

    analytics = load_testdata(spark, SF_MID).analytics
    s1 = fold_shards(None, analytics, None, "20240110")
    write_state(s1, str(tmp_path / "state1"))
    s1 = spark.read.parquet(str(tmp_path / "state1"))
    s2 = fold_shards(s1, analytics, "20240110", "20240120")
    s3 = fold_shards(s2, analytics, "20240120", "20240131")
    whole = first_touch_state(analytics.all())
    assert same(s3, whole)
    assert same(finalize_first_touch(s3, CFG), first_touch(analytics.all(), CFG))


def test_event_job_with_stored_state(spark, tmp_path):
    from lifeline.operators.identity import fold_shards, write_state
    from lifeline.plans import events_job

    inp = load_testdata(spark, SF_MID)
    write_state(fold_shards(None, inp.analytics, None, "20240120"), str(tmp_path / "s"))
    state = spark.read.parquet(str(tmp_path / "s"))
    got = events_job.events_with_identity(inp, CFG, identity_state=state, state_through="20240120")
    assert same(got, events_job.events_with_identity(inp, CFG))


def _py_ntile(i, n, b):
    q, m = divmod(n, b)
    if q == 0:
        return i + 1
    if i < m * (q + 1):
        return i // (q + 1) + 1
    return m + (i - m * (q + 1)) // q + 1


def test_ntile_arithmetic_grid(spark):
    rows = [(i, n, b) for n in range(1, 61) for b in range(1, 21) for i in range(n)]
    df = spark.createDataFrame(rows, "i long, n long, b long")
    got = df.select("i", "n", "b", batching.ntile_of(F.col("i"), F.col("n"), F.col("b")).alias("t"))
    bad = [r for r in got.collect() if r.t != _py_ntile(r.i, r.n, r.b)]
    assert not bad
    # and the Python model is the SQL ntile: spot check against Spark's window
    from pyspark.sql import Window

    one = spark.range(37).withColumn("t", F.ntile(5).over(Window.orderBy("id")))
    assert [r.t for r in one.orderBy("id").collect()] == [_py_ntile(i, 37, 5) for i in range(37)]


@pytest.mark.parametrize("seed", range(4))
def test_identity_random_ties_and_nulls(spark, seed):
    """Many timestamp ties (event_id decides), null client ids and null app
    ids: aggregate form == window form."""
    import datetime as dt

    from lifeline.sources.schemas import ANALYTICS_EVENT_SCHEMA

    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 30, 12)
    rows = []
    for eid in range(400):
        rows.append((
            eid,
            f"h{rnd.randrange(12)}",
            rnd.choice([None, None, "P1", "P2", "P3"]),
            rnd.choice([None, base, base + dt.timedelta(seconds=rnd.randrange(3))]),
            (rnd.choice([None, "1:ios:a", "G-w", "1:android:b"]),),
            "20240130",
        ))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, ANALYTICS_EVENT_SCHEMA).repartition(5)
    assert same(first_touch(df, CFG), identity_by_windows(df, CFG))


@pytest.mark.parametrize("seed", range(4))
def test_latest_entry_random_ties(spark, seed):
    import datetime as dt

    from lifeline.operators.state import lookback_start
    from lifeline.sources.schemas import SNAPSHOT_SCHEMA

    rnd = random.Random(100 + seed)
    today = CFG.today_local
    rows = [
        (f"u{rnd.randrange(8)}", today - dt.timedelta(days=rnd.randrange(10)),
         rnd.choice(["churn", "paying", "trial", None]), dt.date(2023, 1, 1 + rnd.randrange(3)),
         None, None, today, None, 1, None, None)
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, SNAPSHOT_SCHEMA)
    assert same(state.latest_entry(df, CFG), latest_by_rank(df, CFG, lookback_start(CFG)))


def test_bucket_count_grid_matches_python_round(spark):
    rows = [(n, t) for n in range(0, 401) for t in range(1, 41)]
    df = spark.createDataFrame(rows, "n long, t long")
    got = df.select("n", "t", *[
        batching.bucket_count(F.col("n"), t).alias(f"b{t}") for t in range(1, 41)
    ]).collect()
    for r in got:
        want = batching.bucket_count_value(r.n, r.t)
        assert r[f"b{r.t}"] == want == max(1, round(r.n / r.t)), (r.n, r.t)
