"""Registered queries (Spark) and their oracle SQL (DuckDB).

Every query reads the generated tables under ``sf_dir`` through the
bindings, over whole tables.  Names follow the operator inventory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeline.config import SyncConfig
from lifeline.functions.dates import local_date
from lifeline.functions.keys import hashed_user_key
from lifeline.functions.names import event_custom_type
from lifeline.functions.routing import route_columns
from lifeline.operators import batching, checks, delivery, payload, state
from lifeline.operators.identity import first_touch
from lifeline.operators.identity_store import IdentityStore
from lifeline.plans import events_job, oracle, state_job
from lifeline.plans.views import register_views
from lifeline.session import checkpoint_dir
from lifeline.sources.inputs import Inputs, load_testdata

CFG = SyncConfig()
#: The same data as of an earlier day, and with payloads that hold two events.
PAST = replace(CFG, as_of=CFG.as_of - timedelta(days=2))
SMALL_CHUNKS = replace(CFG, max_events_per_payload=2)

Query = Callable[[SparkSession, str], DataFrame]


_BOUND: dict[tuple[int, str], Inputs] = {}


def _inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Bound inputs, built once per (session, folder): lazy DataFrames only,
    no data is held; saves re-listing files and re-reading footers."""
    key = (id(spark), sf_dir)
    if key not in _BOUND or _BOUND[key].snapshot.sparkSession is not spark:
        _BOUND[key] = load_testdata(spark, sf_dir, CFG)
    return _BOUND[key]


def _long(*names: str) -> dict[str, F.Column]:
    return {n: F.col(n).cast("long") for n in names}


def q_scan_snapshot(spark, sf_dir):
    return _inputs(spark, sf_dir).snapshot


def q_scan_subscription_events(spark, sf_dir):
    return _inputs(spark, sf_dir).subscription_events


def q_scan_shard_range(spark, sf_dir):
    df = _inputs(spark, sf_dir).analytics.between(*CFG.state_shard_range)
    return df.select(
        "event_id", "user_id", "user_pseudo_id", "event_timestamp",
        F.col("app_info.firebase_app_id").alias("firebase_app_id"), "suffix",
    )


def q_exclude_test_users(spark, sf_dir):
    return state.exclude_test_users(_inputs(spark, sf_dir).snapshot, CFG)


def q_latest_entry(spark, sf_dir):
    return state.latest_entry(_inputs(spark, sf_dir).snapshot, CFG)


def q_churn_rollup(spark, sf_dir):
    return state.churn_rollup(_inputs(spark, sf_dir).snapshot, CFG)


#: Churn rows through this day are folded first, the later days merged in.
CHURN_THROUGH = CFG.today_local - timedelta(days=3)


def q_churn_rollup_incremental(spark, sf_dir):
    snapshot = _inputs(spark, sf_dir).snapshot
    older = state.churn_state(snapshot, CFG, through=CHURN_THROUGH)
    return state.churn_rollup(snapshot, CFG, older, CHURN_THROUGH)


def q_subscription_state_incremental(spark, sf_dir):
    snapshot = _inputs(spark, sf_dir).snapshot
    older = state.churn_state(snapshot, CFG, through=CHURN_THROUGH)
    return state.subscription_state(snapshot, CFG, stored_churn=older, churn_through=CHURN_THROUGH)


def q_latest_entry_incremental(spark, sf_dir):
    """The latest entries as of three days ago, carried on by the days after."""
    snapshot = _inputs(spark, sf_dir).snapshot
    older = state.latest_entry(snapshot, CFG, through=CHURN_THROUGH)
    return state.latest_entry(snapshot, CFG, older, CHURN_THROUGH)


def q_subscription_state_kept(spark, sf_dir):
    """The state from what a run of three days ago keeps, carried on to
    yesterday, and today's snapshot."""
    inputs = _inputs(spark, sf_dir)
    kept = state_job.SnapshotStates.fold(inputs.snapshot, CFG, CHURN_THROUGH)
    kept = state_job.SnapshotStates.fold(inputs.snapshot, CFG, CFG.yesterday_local, kept)
    return state_job.state_rows(inputs, CFG, kept=kept)


def q_shard_fingerprints(spark, sf_dir):
    shards = _inputs(spark, sf_dir).analytics.fingerprints(CFG.shard(CFG.today_local))
    return shards.select("suffix", "n_rows", "last_event_id")


def q_identity_late_events(spark, sf_dir):
    """Identity folded without a tenth of the events, then from the shards whose
    fingerprints changed when these came: must equal the whole-history identity."""
    from lifeline.operators.identity import finalize_first_touch, first_touch_state, merge_first_touch
    from lifeline.sources.shards import ShardedEvents, changed_shards

    analytics, through = _inputs(spark, sf_dir).analytics, CFG.shard(CFG.today_local)
    late = (F.col("event_id") % 10 == 3) & (F.col("suffix") < STATE_THROUGH)
    early = ShardedEvents(analytics.df.where(~late), derived_from=analytics.derived_from)
    changed = changed_shards(early.fingerprints(through), analytics.fingerprints(through))
    older = first_touch_state(early.between(None, through))
    return finalize_first_touch(merge_first_touch(older, first_touch_state(analytics.only(changed))), CFG)


def q_views_events_of_state_users(spark, sf_dir):
    """SQL over the registered views: yesterday's events of users with a state."""
    register_views(spark, _inputs(spark, sf_dir), CFG)
    return spark.sql(
        """SELECT e.event_type, count(DISTINCT e.user_id) AS n_users, count(*) AS n_events
           FROM lifeline_day_events e LEFT SEMI JOIN lifeline_state_rows s ON e.user_id = s.hashed_user_id
           GROUP BY e.event_type"""
    )


def q_events_identity_store(spark, sf_dir):
    """Identity from a store that was created early and updated twice."""
    inputs = _inputs(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/identity-store-{uuid.uuid4().hex}"
    store = IdentityStore.create(spark, path, inputs.analytics, STATE_THROUGH)
    for through in ("20240122", "20240129"):
        store.update(inputs.analytics, through)
    return events_job.events_with_identity(inputs, CFG, store).select(*events_job.EVENT_ROW_COLUMNS)


def _swc(spark, sf_dir, simplified):
    snap = state.exclude_test_users(_inputs(spark, sf_dir).snapshot, CFG)
    latest = state.latest_entry(snap.select(*state.SB_COLUMNS), CFG)
    return state.snapshot_with_churn(latest, state.churn_rollup(snap, CFG), simplified)


def q_snapshot_with_churn(spark, sf_dir):
    return _swc(spark, sf_dir, simplified=False)


def q_snapshot_with_churn_simplified(spark, sf_dir):
    return _swc(spark, sf_dir, simplified=True)


def q_snapshot_attributes(spark, sf_dir):
    return state.subscription_state(_inputs(spark, sf_dir).snapshot, CFG, with_attributes=True)


def q_subscription_state(spark, sf_dir):
    return state_job.state_rows(_inputs(spark, sf_dir), CFG)


def q_subscription_status(spark, sf_dir):
    return state.status_counts(state_job.state_rows(_inputs(spark, sf_dir), CFG))


def q_hash_user_key(spark, sf_dir):
    users = _inputs(spark, sf_dir).snapshot.select("user_id").distinct()
    return users.select(
        "user_id", hashed_user_key(F.col("user_id"), CFG.user_key_prefix).alias("hashed_user_id")
    )


def q_identity_first_touch(spark, sf_dir):
    return first_touch(_inputs(spark, sf_dir).analytics.between(None, CFG.shard(CFG.today_local)), CFG)


# identity kept as a state table: shards through this day folded first,
# the rest merged in afterwards (must equal the whole-history identity)
STATE_THROUGH = "20240115"


def q_identity_first_touch_incremental(spark, sf_dir):
    from lifeline.operators.identity import finalize_first_touch, fold_shards

    analytics = _inputs(spark, sf_dir).analytics
    older = fold_shards(None, analytics, None, STATE_THROUGH)
    latest = fold_shards(older, analytics, STATE_THROUGH, CFG.shard(CFG.today_local))
    return finalize_first_touch(latest, CFG)


def q_route_endpoint(spark, sf_dir):
    ident = first_touch(_inputs(spark, sf_dir).analytics.between(None, CFG.shard(CFG.today_local)), CFG)
    r = route_columns(F.col("app_id"), CFG)
    return ident.select("user_id", "app_id", *[c.alias(n) for n, c in r.items()])


def q_state_identity_join(spark, sf_dir):
    return state_job.state_with_identity(_inputs(spark, sf_dir), CFG)


def q_state_identity_join_incremental(spark, sf_dir):
    """Day states of every complete shard through yesterday (built here from
    the raw shards), today's shard raw: same rows as state_identity_join."""
    from lifeline.operators.identity import day_states

    inputs = _inputs(spark, sf_dir)
    through = CFG.shard(CFG.yesterday_local)
    stored = day_states(inputs.analytics.between(None, through))
    return state_job.state_with_identity(inputs, CFG, stored, through)


def q_state_projection(spark, sf_dir):
    return state_job.state_projection(_inputs(spark, sf_dir), CFG)


def q_local_event_date(spark, sf_dir):
    ev = _inputs(spark, sf_dir).subscription_events
    return ev.select("event_id", "event_ts", local_date(F.col("event_ts"), CFG.zone).alias("date_of_change"))


def q_event_name_map(spark, sf_dir):
    ev = _inputs(spark, sf_dir).subscription_events
    return ev.select("event_id", "event_type", event_custom_type(F.col("event_type")).alias("event_custom_type"))


def q_events_of_day(spark, sf_dir):
    return events_job.day_events(_inputs(spark, sf_dir), CFG)


def q_events_identity_join(spark, sf_dir):
    return events_job.event_rows(_inputs(spark, sf_dir), CFG)


def q_events_of_day_sorted(spark, sf_dir):
    return events_job.event_rows_in_order(_inputs(spark, sf_dir), CFG).orderBy("pos")


def q_user_events_window(spark, sf_dir):
    lists = events_job.event_lists(_inputs(spark, sf_dir), CFG)
    return lists.select(
        "user_id",
        F.col("_chunk").alias("chunk"),
        F.size("events").cast("long").alias("n_events"),
        F.to_json("events").alias("events_json"),
    )


def q_payload_state(spark, sf_dir):
    return state_job.state_payloads(_inputs(spark, sf_dir), CFG)


def q_payload_events(spark, sf_dir):
    return events_job.event_payloads(_inputs(spark, sf_dir), CFG).withColumns(
        _long("chunk", "n_events")
    )


def q_payload_events_chunked(spark, sf_dir):
    """Two events a payload, so most users have several chunks."""
    return events_job.event_payloads(_inputs(spark, sf_dir), SMALL_CHUNKS).withColumns(_long("chunk", "n_events"))


def q_subscription_state_past_day(spark, sf_dir):
    """The state as of an earlier day: later snapshots are not read."""
    return state_job.state_rows(_inputs(spark, sf_dir), PAST)


def q_events_identity_past_day(spark, sf_dir):
    return events_job.event_rows(_inputs(spark, sf_dir), PAST)


def _wire(bucketed: DataFrame, schema) -> DataFrame:
    w = payload.wire_rows(bucketed, schema)
    return w.select(
        "app_id", "user_id", "url", "body",
        F.col("content_length").cast("long").alias("content_length"), "deliverable",
    )


def q_wire_body(spark, sf_dir):
    return _wire(state_job.state_payloads(_inputs(spark, sf_dir), CFG), payload.STATE_PAYLOAD_SCHEMA)


def q_wire_body_events(spark, sf_dir):
    return _wire(events_job.event_payloads(_inputs(spark, sf_dir), CFG), payload.EVENT_PAYLOAD_SCHEMA)


def q_bucket_plan(spark, sf_dir):
    return batching.bucket_plan(state_job.state_payloads(_inputs(spark, sf_dir), CFG), CFG)


def q_ntile_buckets(spark, sf_dir):
    b = state_job.state_bucketed(_inputs(spark, sf_dir), CFG)
    return b.select("app_id", "user_id", "payload_json", F.col("bucket").cast("long").alias("bucket"))


# range-partitioned ntile forced (8 range partitions), whatever the size
RANGE_CFG = SyncConfig(bucket_partitions=8)


def q_ntile_buckets_scalable(spark, sf_dir):
    b = state_job.state_bucketed(_inputs(spark, sf_dir), RANGE_CFG)
    return b.select("app_id", "user_id", "payload_json", F.col("bucket").cast("long").alias("bucket"))


def _batches(bucketed: DataFrame) -> DataFrame:
    return batching.batches(bucketed).withColumns(_long("bucket", "n_payloads"))


def q_batch_json_state(spark, sf_dir):
    return _batches(state_job.state_bucketed(_inputs(spark, sf_dir), CFG))


def q_batch_json_events(spark, sf_dir):
    return _batches(events_job.event_bucketed(_inputs(spark, sf_dir), CFG))


def q_batch_roundtrip(spark, sf_dir):
    b = _batches(state_job.state_bucketed(_inputs(spark, sf_dir), CFG))
    return checks.batch_roundtrip(b, payload.STATE_PAYLOAD_SCHEMA).withColumns(
        _long("pos", "n_events")
    )


def q_batch_size_check(spark, sf_dir):
    return checks.batch_size_check(_batches(state_job.state_bucketed(_inputs(spark, sf_dir), CFG)))


def q_first_batch(spark, sf_dir):
    return checks.first_batch(_batches(state_job.state_bucketed(_inputs(spark, sf_dir), CFG)))


def q_preview_top20(spark, sf_dir):
    return checks.preview(_batches(state_job.state_bucketed(_inputs(spark, sf_dir), CFG)), 20)


def _ledger(spark, sf_dir):
    b = batching.batches(state_job.state_bucketed(_inputs(spark, sf_dir), CFG))
    return delivery.deliver(b, payload.STATE_PAYLOAD_SCHEMA, CFG)


def q_delivery_ledger(spark, sf_dir):
    return _ledger(spark, sf_dir)


def q_delivery_status_rollup(spark, sf_dir):
    return delivery.status_rollup(_ledger(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "scan_snapshot": q_scan_snapshot,
    "scan_subscription_events": q_scan_subscription_events,
    "scan_shard_range": q_scan_shard_range,
    "exclude_test_users": q_exclude_test_users,
    "latest_entry": q_latest_entry,
    "churn_rollup": q_churn_rollup,
    "churn_rollup_incremental": q_churn_rollup_incremental,
    "subscription_state_incremental": q_subscription_state_incremental,
    "latest_entry_incremental": q_latest_entry_incremental,
    "subscription_state_kept": q_subscription_state_kept,
    "shard_fingerprints": q_shard_fingerprints,
    "identity_late_events": q_identity_late_events,
    "events_identity_store": q_events_identity_store,
    "views_events_of_state_users": q_views_events_of_state_users,
    "payload_events_chunked": q_payload_events_chunked,
    "subscription_state_past_day": q_subscription_state_past_day,
    "events_identity_past_day": q_events_identity_past_day,
    "snapshot_with_churn": q_snapshot_with_churn,
    "snapshot_with_churn_simplified": q_snapshot_with_churn_simplified,
    "snapshot_attributes": q_snapshot_attributes,
    "subscription_state": q_subscription_state,
    "subscription_status": q_subscription_status,
    "hash_user_key": q_hash_user_key,
    "identity_first_touch": q_identity_first_touch,
    "identity_first_touch_incremental": q_identity_first_touch_incremental,
    "route_endpoint": q_route_endpoint,
    "state_identity_join": q_state_identity_join,
    "state_identity_join_incremental": q_state_identity_join_incremental,
    "state_projection": q_state_projection,
    "local_event_date": q_local_event_date,
    "event_name_map": q_event_name_map,
    "events_of_day": q_events_of_day,
    "events_identity_join": q_events_identity_join,
    "events_of_day_sorted": q_events_of_day_sorted,
    "user_events_window": q_user_events_window,
    "payload_state": q_payload_state,
    "payload_events": q_payload_events,
    "wire_body": q_wire_body,
    "wire_body_events": q_wire_body_events,
    "bucket_plan": q_bucket_plan,
    "ntile_buckets": q_ntile_buckets,
    "ntile_buckets_scalable": q_ntile_buckets_scalable,
    "batch_json_state": q_batch_json_state,
    "batch_json_events": q_batch_json_events,
    "batch_roundtrip": q_batch_roundtrip,
    "batch_size_check": q_batch_size_check,
    "first_batch": q_first_batch,
    "preview_top20": q_preview_top20,
    "delivery_ledger": q_delivery_ledger,
    "delivery_status_rollup": q_delivery_status_rollup,
}


def _sql(cfg: SyncConfig) -> dict[str, str]:
    W = oracle.ctes(cfg)
    sb = ", ".join(
        f"{c}" for c in state.SB_COLUMNS
    )
    wire_state = oracle.wire_sql("state", cfg)
    rs = oracle.route_sql(cfg)
    ledger = f"""{W}, {wire_state}
SELECT batch_id, payload_index, payload_id, route, deliverable,
       CAST(content_length AS INTEGER) AS content_length,
       deliverable AS sent,
       CAST(CASE WHEN deliverable THEN 204 ELSE 0 END AS INTEGER) AS status_code
FROM wire_state"""
    return {
        "scan_snapshot": f"{W} SELECT * FROM snapshot",
        "scan_subscription_events": f"{W} SELECT * FROM sub_events",
        "scan_shard_range": f"{W} SELECT * FROM analytics WHERE suffix BETWEEN "
        + "'{}' AND '{}'".format(*cfg.state_shard_range),
        "exclude_test_users": f"{W} SELECT * FROM snapshot WHERE NOT (user_id LIKE '{cfg.test_user_prefix}%')",
        "latest_entry": f"{W} SELECT * FROM latest_all",
        "churn_rollup": f"{W} SELECT * FROM churn_all",
        "latest_entry_incremental": f"{W} SELECT * FROM latest_all",
        "subscription_state_kept": f"{W} SELECT * FROM state",
        "shard_fingerprints": f"{W} SELECT suffix, count(*) AS n_rows, max(event_id) AS last_event_id FROM analytics "
        f"WHERE suffix <= '{cfg.events_shard_range[1]}' GROUP BY suffix",
        "identity_late_events": f"{W} SELECT * FROM ident_all",
        "views_events_of_state_users": f"""{W} SELECT event_type, count(DISTINCT user_id) AS n_users, count(*) AS n_events
            FROM day_events WHERE user_id IN (SELECT hashed_user_id FROM state_ident) GROUP BY event_type""",
        "events_identity_store": f"""{W} SELECT user_id, event_custom_type, date_of_change, client_id, app_id, mp_url,
            subscription_id, offer_type FROM events_ident""",
        "churn_rollup_incremental": f"{W} SELECT * FROM churn_all",
        "subscription_state_incremental": f"{W} SELECT * FROM state",
        "snapshot_with_churn": f"{W} SELECT {sb}, churn_type, churn_end_date FROM swc",
        "snapshot_with_churn_simplified": f"{W} SELECT {sb}, churn_type, churn_end_date FROM swc",
        "snapshot_attributes": f"{W} SELECT * FROM state_attrs",
        "subscription_state": f"{W} SELECT * FROM state",
        "subscription_status": f"{W} SELECT subscription_status, count(*) AS n_states FROM state GROUP BY 1",
        "hash_user_key": f"{W} SELECT DISTINCT user_id, sha256('{cfg.user_key_prefix}' || user_id) AS hashed_user_id FROM snapshot",
        "identity_first_touch": f"{W} SELECT * FROM ident_all",
        "identity_first_touch_incremental": f"{W} SELECT * FROM ident_all",
        "route_endpoint": f"""{W} SELECT user_id, app_id, {rs['route']} AS route, {rs['app_secret']} AS app_secret,
            {rs['endpoint']} AS endpoint, {rs['mp_url']} AS mp_url FROM ident_all""",
        "state_identity_join": f"{W} SELECT * FROM state_ident",
        "state_identity_join_incremental": f"{W} SELECT * FROM state_ident",
        "state_projection": f"{W} SELECT * FROM state_proj",
        "local_event_date": f"""{W} SELECT event_id, event_ts,
            CAST(timezone('{cfg.zone}', event_ts AT TIME ZONE 'UTC') AS DATE) AS date_of_change FROM sub_events""",
        "event_name_map": f"{W} SELECT event_id, event_type, {oracle._name_case('event_type')} AS event_custom_type FROM sub_events",
        "events_of_day": f"{W} SELECT * FROM day_events",
        "events_identity_join": f"""{W} SELECT user_id, event_custom_type, date_of_change, client_id, app_id, mp_url,
            subscription_id, offer_type FROM events_ident""",
        "events_of_day_sorted": f"""{W} SELECT user_id, event_custom_type, date_of_change, client_id, app_id, mp_url,
            subscription_id, offer_type, row_number() OVER (ORDER BY user_id DESC NULLS LAST, event_custom_type NULLS FIRST,
              date_of_change NULLS FIRST, client_id NULLS FIRST, app_id NULLS FIRST, mp_url NULLS FIRST,
              subscription_id NULLS FIRST, offer_type NULLS FIRST, event_type NULLS FIRST) AS pos
            FROM events_ident ORDER BY pos""",
        "user_events_window": f"""{W} SELECT user_id, chunk, CAST(len(events) AS BIGINT) AS n_events,
            CAST(to_json(events) AS VARCHAR) AS events_json FROM ev_lists""",
        "payload_events_chunked": f"{oracle.ctes(SMALL_CHUNKS)} SELECT app_id, user_id, chunk, n_events, payload_json FROM payload_events",
        "subscription_state_past_day": f"{oracle.ctes(PAST)} SELECT * FROM state",
        "events_identity_past_day": f"""{oracle.ctes(PAST)} SELECT user_id, event_custom_type, date_of_change, client_id,
            app_id, mp_url, subscription_id, offer_type FROM events_ident""",
        "payload_state": f"{W} SELECT app_id, user_id, payload_json FROM payload_state",
        "payload_events": f"{W} SELECT app_id, user_id, chunk, n_events, payload_json FROM payload_events",
        "wire_body": f"{W}, {wire_state} SELECT app_id, user_id, url, body, content_length, deliverable FROM wire_state",
        "wire_body_events": f"{W}, {oracle.wire_sql('events', cfg)} SELECT app_id, user_id, url, body, content_length, deliverable FROM wire_events",
        "bucket_plan": f"""{W} SELECT count(*) AS n_payloads,
            greatest(1, CAST(round_even(count(*) / {cfg.target_batch_size}, 0) AS BIGINT)) AS n_buckets FROM payload_state""",
        "ntile_buckets": f"{W} SELECT app_id, user_id, payload_json, bucket FROM bucketed_state",
        "ntile_buckets_scalable": f"{W} SELECT app_id, user_id, payload_json, bucket FROM bucketed_state",
        "batch_json_state": f"{W} SELECT * FROM batch_state",
        "batch_json_events": f"{W} SELECT * FROM batch_events",
        "batch_roundtrip": f"""{W} SELECT app_id, bucket,
            row_number() OVER (PARTITION BY app_id, bucket ORDER BY user_id, payload_json) - 1 AS pos,
            user_id, client_id, mp_url AS url, CAST(1 AS BIGINT) AS n_events FROM bucketed_state""",
        "batch_size_check": f"""{W} SELECT app_id, count(*) AS n_batches, CAST(sum(n_payloads) AS BIGINT) AS n_payloads,
            CAST(min(n_payloads) AS BIGINT) AS min_batch, CAST(max(n_payloads) AS BIGINT) AS max_batch
            FROM batch_state GROUP BY app_id""",
        "first_batch": f"{W} SELECT * FROM batch_state ORDER BY app_id, bucket LIMIT 1",
        "preview_top20": f"{W} SELECT * FROM batch_state ORDER BY app_id, bucket LIMIT 20",
        "delivery_ledger": ledger,
        "delivery_status_rollup": f"""WITH l AS ({ledger})
            SELECT route, sent, status_code, count(*) AS n_payloads,
                   CAST(sum(content_length) AS BIGINT) AS bytes
            FROM l GROUP BY route, sent, status_code""",
    }


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql(cfg: SyncConfig = CFG) -> dict[str, str]:
    return _sql(cfg)
