"""Job B: yesterday's subscription events -> event payload batches.

events of the local day (distinct) -> + first-touch identity over the
configured shards (all history by default) -> event names + route ->
payloads of at most ``max_events_per_payload`` events per user -> batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeline.config import SyncConfig
from lifeline.functions.names import event_custom_type
from lifeline.functions.routing import route_columns
from lifeline.operators import batching, payload
from lifeline.operators.events import events_of_day
from lifeline.operators.identity import (
    finalize_first_touch,
    first_touch,
    first_touch_state,
    key_filter,
    merge_first_touch,
)
from lifeline.operators.identity_store import IdentityStore
from lifeline.operators.numbering import number_rows
from lifeline.session import reliable_checkpoint
from lifeline.sources.inputs import Inputs

EVENT_ROW_COLUMNS = (
    "user_id",
    "event_custom_type",
    "date_of_change",
    "client_id",
    "app_id",
    "mp_url",
    "subscription_id",
    "offer_type",
)


def day_events(inputs: Inputs, cfg: SyncConfig) -> DataFrame:
    return events_of_day(inputs.subscription_events, cfg)


def day_identity(
    inputs: Inputs,
    cfg: SyncConfig,
    keys: DataFrame,
    identity_state: DataFrame | IdentityStore | None = None,
    state_through: str | None = None,
    n_keys: int | None = None,
) -> DataFrame:
    """First-touch identity of ``keys``.  Without a stored state, over the
    configured shard scope (all history through today by default).  With
    ``identity_state`` covering shards through ``state_through`` (an
    ``IdentityStore`` knows its own), only the later shards are read and merged
    into it (same result)."""
    if identity_state is None:
        return first_touch(
            inputs.analytics.between(*cfg.events_shard_range), cfg, keys=keys, n_keys=n_keys
        )
    if cfg.events_identity_days is not None:
        raise ValueError("a stored identity state covers all history")
    only_keys = key_filter(keys, cfg, n_keys)
    if isinstance(identity_state, IdentityStore):
        state_through = identity_state.current().through
        state = identity_state.lookup(keys.select("user_id").distinct())
    else:
        state = only_keys(identity_state)
    fresh = only_keys(inputs.analytics.between(state_through, cfg.shard(cfg.today_local), low_inclusive=False))
    return finalize_first_touch(merge_first_touch(state, first_touch_state(fresh)), cfg)


def events_with_identity(
    inputs: Inputs,
    cfg: SyncConfig,
    identity_state: DataFrame | IdentityStore | None = None,
    state_through: str | None = None,
    numbered: bool = False,
) -> DataFrame:
    """Day events of users known to analytics, named and routed; keeps the
    raw ``event_type`` (the payload order uses it as the last tie-break).
    ``numbered`` adds each event's place among its user's (``_rn``); identity is
    one row per user, so the places hold after the join.

    Only the day's users are looked up: a bitmap of their keys is broadcast
    ahead of the identity aggregate (see ``key_filter``).  The
    day's distinct rows are checkpointed (in order, if they are numbered), so
    the event fact is scanned once; keys, their count and the join read the checkpoint.
    """
    day = day_events(inputs, cfg).withColumn("event_custom_type", event_custom_type(F.col("event_type")))
    day = payload.number_user_events(day) if numbered else reliable_checkpoint(day)
    ident = day_identity(inputs, cfg, day.select("user_id"), identity_state, state_through)
    r = route_columns(F.col("app_id"), cfg)
    return day.join(ident, "user_id", "inner").select(
        "user_id",
        "event_custom_type",
        "date_of_change",
        "client_id",
        "app_id",
        r["mp_url"].alias("mp_url"),
        "subscription_id",
        "offer_type",
        "event_type",
        *(["_rn"] if numbered else []),
    )


def event_rows(inputs: Inputs, cfg: SyncConfig) -> DataFrame:
    return events_with_identity(inputs, cfg).select(*EVENT_ROW_COLUMNS)


def event_rows_in_order(inputs: Inputs, cfg: SyncConfig) -> DataFrame:
    """The event rows with ``pos``, their place when sorted by user, the last
    first, and then by all other columns; without gaps over the whole result."""
    rest = [F.col(c).asc_nulls_first() for c in EVENT_ROW_COLUMNS if c != "user_id"]
    rows = events_with_identity(inputs, cfg)
    order = [F.col("user_id").desc_nulls_last(), *rest, F.col("event_type").asc_nulls_first()]
    return number_rows(rows, order, "pos").select(*EVENT_ROW_COLUMNS, "pos")


def event_lists(inputs: Inputs, cfg: SyncConfig) -> DataFrame:
    return payload.user_event_lists(events_with_identity(inputs, cfg, numbered=True), cfg)


def event_payloads(
    inputs: Inputs,
    cfg: SyncConfig,
    identity_state: DataFrame | IdentityStore | None = None,
    state_through: str | None = None,
) -> DataFrame:
    return payload.event_payloads(events_with_identity(inputs, cfg, identity_state, state_through, numbered=True), cfg)


def event_bucketed(inputs: Inputs, cfg: SyncConfig) -> DataFrame:
    return batching.assign_buckets(event_payloads(inputs, cfg), cfg)


def event_batches(inputs: Inputs, cfg: SyncConfig) -> DataFrame:
    return batching.batches(event_bucketed(inputs, cfg))
