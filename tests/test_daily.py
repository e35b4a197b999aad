"""The daily runs end to end on the bound test tables."""

from folders import SF_SMALL
from lifeline.config import SyncConfig
from lifeline.operators.identity import fold_shards, write_state
from lifeline.plans import daily, registry
from lifeline.sources.inputs import Inputs, load_testdata

CFG = SyncConfig()


def test_state_sync(spark, tmp_path):
    res = daily.run_state_sync(spark, load_testdata(spark, SF_SMALL), CFG, str(tmp_path))
    assert res.ledger.count() == res.batches.agg({"n_payloads": "sum"}).first()[0]
    want = registry.q_batch_json_state(spark, SF_SMALL).drop("n_payloads")
    got = res.batches.drop("n_payloads")
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_events_sync_with_identity_state(spark, tmp_path):
    inp = load_testdata(spark, SF_SMALL)
    write_state(fold_shards(None, inp.analytics, None, "20240115"), str(tmp_path / "v1"))
    res = daily.run_events_sync(
        spark, inp, CFG, str(tmp_path / "run"), None,
        identity_state_path=str(tmp_path / "v1"), state_through="20240115",
        new_identity_state_path=str(tmp_path / "v2"),
    )
    plain = registry.q_batch_json_events(spark, SF_SMALL)
    got = res.batches.select(
        "app_id", res.batches.bucket.cast("long").alias("bucket"), "n_payloads", "payload_array")
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    assert spark.read.parquet(str(tmp_path / "v2")).count() > 0


def test_production_layout_roundtrip(spark, tmp_path):
    """Write the bound inputs in the production layout, read them with the
    declared schemas, and get the same state batches."""
    inp = load_testdata(spark, SF_SMALL)
    inp.snapshot.write.parquet(str(tmp_path / "snap"))
    inp.subscription_events.write.parquet(str(tmp_path / "subs"))
    inp.analytics.write(str(tmp_path / "analytics"))
    stored = Inputs.read(spark, str(tmp_path / "snap"), str(tmp_path / "subs"), str(tmp_path / "analytics"))
    a = daily.run_state_sync(spark, stored, CFG, str(tmp_path / "a")).batches
    b = daily.run_state_sync(spark, inp, CFG, str(tmp_path / "b")).batches
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_state_sync_with_day_states(spark, tmp_path):
    """Day states stored through an earlier day; the run appends the missing
    complete days, reads them back (suffix kept a string) and gets the same
    batches as reading raw shards."""
    from lifeline.operators.identity import day_states, read_day_states, write_day_states

    inp = load_testdata(spark, SF_SMALL)
    path = str(tmp_path / "days")
    write_day_states(day_states(inp.analytics.between(None, "20240120")), path)
    res = daily.run_state_sync(spark, inp, CFG, str(tmp_path / "run"), None, path, "20240120")
    stored = read_day_states(spark, path)
    assert dict(stored.dtypes)["suffix"] == "string"
    assert stored.where("suffix = '20240130'").count() > 0
    plain = registry.q_batch_json_state(spark, SF_SMALL)
    got = res.batches.select("app_id", res.batches.bucket.cast("long").alias("bucket"), "n_payloads", "payload_array")
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_command_line(spark, tmp_path, capsys):
    """Both jobs through the command line on the production layout."""
    inp = load_testdata(spark, SF_SMALL)
    inp.snapshot.write.parquet(str(tmp_path / "snap"))
    inp.subscription_events.write.parquet(str(tmp_path / "subs"))
    inp.analytics.write(str(tmp_path / "analytics"))
    common = ["--snapshot", str(tmp_path / "snap"), "--subscription-events", str(tmp_path / "subs"),
              "--analytics", str(tmp_path / "analytics"), "--as-of", "2024-01-31T12:00:00+00:00"]
    daily.main(["state", *common, "--out", str(tmp_path / "out_state"),
                "--day-states", str(tmp_path / "days")])
    daily.main(["events", *common, "--out", str(tmp_path / "out_events"),
                "--new-identity-state", str(tmp_path / "ident_v1")])
    printed = capsys.readouterr().out
    assert "'sent': True" in printed and "'status_code': 204" in printed
    for name in ("out_state/state_batches", "out_state/state_ledger", "out_events/events_batches",
                 "out_events/events_ledger", "days", "ident_v1"):
        assert (tmp_path / name).is_dir(), name
    want = registry.q_batch_json_events(spark, SF_SMALL)
    got = spark.read.parquet(str(tmp_path / "out_events/events_batches"))
    got = got.select("app_id", got.bucket.cast("long").alias("bucket"), "n_payloads", "payload_array")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_empty_day_runs_clean(spark, tmp_path):
    """A day without subscription events: empty payloads, batches and ledger,
    no errors (size checks on zero rows, empty broadcasts, empty ntile)."""
    import datetime as dt

    from lifeline.plans import events_job

    cfg = SyncConfig(as_of=dt.datetime(2030, 6, 1, 12, tzinfo=dt.timezone.utc))
    inp = load_testdata(spark, SF_SMALL, cfg)
    assert events_job.event_payloads(inp, cfg).count() == 0
    res = daily.run_events_sync(spark, inp, cfg, str(tmp_path))
    assert res.batches.count() == 0 and res.ledger.count() == 0
