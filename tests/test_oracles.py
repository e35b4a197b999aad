"""Every registered query agrees with its DuckDB oracle (rows, columns,
order-insensitive values) on the small generated tables."""

import pytest

import __spark_entry__ as E
from lifeline.plans import registry
from folders import SF_SMALL
from tools.check_oracles import duck, frame_hash, type_diff

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(registry.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert frame_hash(got) == frame_hash(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["app_id", "bucket", "n_payloads", "payload_array"]
    assert df.count() > 0


def _oracle(con, cfg, select):
    from lifeline.plans.oracle import ctes

    return con.execute(ctes(cfg) + select).df()


def test_range_partitioned_batches_match_oracle(spark, con):
    """Force the range-partitioned ntile and compare the batches with the
    SQL ntile."""
    from folders import SF_MID
    from lifeline.config import SyncConfig
    from lifeline.plans import state_job
    from lifeline.sources.inputs import load_testdata

    cfg = SyncConfig(rows_per_range_partition=16)
    mid = duck(SF_MID)
    got = state_job.state_batches(load_testdata(spark, SF_MID, cfg), cfg).toPandas()
    got = got.astype({"bucket": "int64"})
    want = _oracle(mid, cfg, " SELECT * FROM batch_state")
    assert frame_hash(got) == frame_hash(want)


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, con, name):
    """Same column names and corresponding types on both sides."""
    sdf = E.queries()[name](spark, SF_SMALL)
    assert type_diff(sdf, con.sql(E.oracle_sql()[name])) == {}


def test_beyond_every_size_bound_matches_oracle(spark, monkeypatch):
    """All broadcast bounds at their least: a key bitmap of one piece, ntile
    offsets joined without broadcast; tiny chunk and partition sizes.  Same batches as SQL."""
    from folders import SF_MID
    from lifeline.config import SyncConfig
    from lifeline.operators import batching
    from lifeline.plans import events_job
    from lifeline.sources.inputs import load_testdata

    monkeypatch.setattr(batching, "OFFSETS_BROADCAST_MAX", 0)
    cfg = SyncConfig(identity_filter_bits=0, max_events_per_payload=2, bucket_partitions=4)
    mid = duck(SF_MID)
    got = events_job.event_batches(load_testdata(spark, SF_MID, cfg), cfg).toPandas()
    got = got.astype({"bucket": "int64"})
    want = _oracle(mid, cfg, " SELECT * FROM batch_events")
    assert frame_hash(got) == frame_hash(want)


def test_event_identity_over_a_shard_window_matches_oracle(spark):
    from folders import SF_MID
    from lifeline.config import SyncConfig
    from lifeline.plans import events_job
    from lifeline.sources.inputs import load_testdata

    cfg = SyncConfig(events_identity_days=3)
    mid = duck(SF_MID)
    got = events_job.event_rows(load_testdata(spark, SF_MID, cfg), cfg).toPandas()
    want = _oracle(mid, cfg, """ SELECT user_id, event_custom_type, date_of_change, client_id, app_id,
        mp_url, subscription_id, offer_type FROM events_ident""")
    assert frame_hash(got) == frame_hash(want)
    full = events_job.event_rows(load_testdata(spark, SF_MID), SyncConfig()).toPandas()
    assert frame_hash(got) != frame_hash(full)  # the window changes first touches


def test_custom_routes_match_oracle(spark):
    from folders import SF_MID
    from lifeline.config import Route, SyncConfig
    from lifeline.plans import registry, state_job
    from lifeline.plans.oracle import wire_sql
    from lifeline.operators import payload
    from lifeline.sources.inputs import load_testdata

    cfg = SyncConfig(
        endpoint_base="https://other.example.invalid/collect",
        routes=(Route("android", "android", "app", "k-and"), Route("web", "G-", "mid", "k-web"),
                Route("ios", "ios", "app", "k-ios"), Route("rest", None, "id", "k-rest")),
    )
    mid = duck(SF_MID)
    inp = load_testdata(spark, SF_MID, cfg)
    got = state_job.state_projection(inp, cfg).toPandas()
    assert set(got["route"]) == {"android", "web", "ios"}  # the data has no catch-all app id
    assert frame_hash(got) == frame_hash(_oracle(mid, cfg, " SELECT * FROM state_proj"))
    wired = registry._wire(state_job.state_payloads(inp, cfg), payload.STATE_PAYLOAD_SCHEMA).toPandas()
    want = _oracle(mid, cfg, ", " + wire_sql("state", cfg)
                   + " SELECT app_id, user_id, url, body, content_length, deliverable FROM wire_state")
    assert frame_hash(wired) == frame_hash(want)
