"""Job A: current subscription state -> user-property payload batches.

state (snapshot) -> + first-touch identity (two local days of shards) ->
text projection + route -> one payload per state row -> batches.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeline.config import SyncConfig
from lifeline.functions.dates import date_text
from lifeline.functions.keys import hashed_user_key
from lifeline.functions.routing import route_columns
from lifeline.operators import batching, payload, state
from lifeline.operators.identity import finalize_first_touch, range_state
from lifeline.sources.inputs import Inputs

STATE_ROW_COLUMNS = (
    "subscription_cancel_date",
    "subscription_renewal_date",
    "subscription_start_date",
    "subscription_end_date",
    "subscription_status",
    "raw_user_id",
    "hashed_user_id",
    "client_id",
    "app_id",
)


@dataclass(frozen=True)
class SnapshotStates:
    """What a run keeps of the snapshot through a day: the latest entries (with
    test users) and the churn state."""

    latest: DataFrame
    churn: DataFrame
    through: dt.date

    @classmethod
    def fold(cls, snapshot: DataFrame, cfg: SyncConfig, through: dt.date, before: "SnapshotStates | None" = None) -> "SnapshotStates":
        """The states through ``through``, of all days or of those after ``before``."""
        rows = snapshot.select(*state.SB_COLUMNS)
        if before is None:
            return cls(state.latest_entry(rows, cfg, through=through), state.churn_state(snapshot, cfg, through=through), through)
        latest = state.latest_entry(rows, cfg, before.latest, before.through, through)
        fresh = state.churn_state(snapshot, cfg, after=before.through, through=through)
        return cls(latest, state.merge_churn(before.churn, fresh), through)

    @classmethod
    def read(cls, spark: SparkSession, path: str, through: dt.date) -> "SnapshotStates":
        return cls(spark.read.parquet(f"{path}/latest"), spark.read.parquet(f"{path}/churn"), through)

    def write(self, path: str) -> None:
        self.latest.write.mode("errorifexists").parquet(f"{path}/latest")
        self.churn.write.mode("errorifexists").parquet(f"{path}/churn")


def state_rows(inputs: Inputs, cfg: SyncConfig, simplified: bool = True, kept: SnapshotStates | None = None) -> DataFrame:
    stored = (kept.churn, kept.through, kept.latest, kept.through) if kept else ()
    return state.subscription_state(inputs.snapshot, cfg, simplified, False, *stored)


def state_scope_identity(
    inputs: Inputs,
    cfg: SyncConfig,
    day_states: DataFrame | None = None,
    states_through: str | None = None,
) -> DataFrame:
    """First-touch identity over the state shard range; with a day-state
    table covering shards through ``states_through``, those days are read
    from it and only later shards raw."""
    lo, hi = cfg.state_shard_range
    state = range_state(inputs.analytics, lo, hi, day_states, states_through)
    return finalize_first_touch(state, cfg)


def state_with_identity(
    inputs: Inputs,
    cfg: SyncConfig,
    day_states: DataFrame | None = None,
    states_through: str | None = None,
    kept: SnapshotStates | None = None,
) -> DataFrame:
    """State rows of users seen in the state shard range, with their
    first-touch client and app id.

    Identity is one row per user, so every state row matches at most once
    and the distinct state rows stay distinct: no DISTINCT needed after.
    """
    keyed = state_rows(inputs, cfg, kept=kept).withColumn(
        "hashed_user_id", hashed_user_key(F.col("user_id"), cfg.user_key_prefix)
    )
    ident = state_scope_identity(inputs, cfg, day_states, states_through).withColumnRenamed(
        "user_id", "hashed_user_id"
    )
    return keyed.join(ident, "hashed_user_id", "inner").select(
        "subscription_cancel_date",
        F.col("subscription_next_renewal_date").alias("subscription_renewal_date"),
        "subscription_start_date",
        "subscription_end_date",
        "subscription_status",
        F.col("user_id").alias("raw_user_id"),
        "hashed_user_id",
        "client_id",
        "app_id",
    )


def state_projection(
    inputs: Inputs,
    cfg: SyncConfig,
    day_states: DataFrame | None = None,
    states_through: str | None = None,
    kept: SnapshotStates | None = None,
) -> DataFrame:
    """Dates as ``yyyy-MM-dd`` text, a missing cancel date or client id as
    the empty string, plus the route of the app id."""
    rows = state_with_identity(inputs, cfg, day_states, states_through, kept)
    r = route_columns(F.col("app_id"), cfg)
    return rows.select(
        F.coalesce(date_text(F.col("subscription_cancel_date")), F.lit("")).alias(
            "subscription_cancel_date"
        ),
        F.coalesce(F.col("client_id"), F.lit("")).alias("client_id"),
        date_text(F.col("subscription_renewal_date")).alias("subscription_renewal_date"),
        date_text(F.col("subscription_start_date")).alias("subscription_start_date"),
        date_text(F.col("subscription_end_date")).alias("subscription_end_date"),
        "hashed_user_id",
        "app_id",
        "subscription_status",
        r["route"].alias("route"),
        r["app_secret"].alias("app_secret"),
        r["mp_url"].alias("mp_url"),
    )


def state_payloads(
    inputs: Inputs,
    cfg: SyncConfig,
    day_states: DataFrame | None = None,
    states_through: str | None = None,
    kept: SnapshotStates | None = None,
) -> DataFrame:
    return payload.state_payloads(
        state_projection(inputs, cfg, day_states, states_through, kept), cfg
    )


def state_bucketed(
    inputs: Inputs,
    cfg: SyncConfig,
    day_states: DataFrame | None = None,
    states_through: str | None = None,
    kept: SnapshotStates | None = None,
) -> DataFrame:
    return batching.assign_buckets(state_payloads(inputs, cfg, day_states, states_through, kept), cfg)


def state_batches(
    inputs: Inputs,
    cfg: SyncConfig,
    day_states: DataFrame | None = None,
    states_through: str | None = None,
    kept: SnapshotStates | None = None,
) -> DataFrame:
    return batching.batches(state_bucketed(inputs, cfg, day_states, states_through, kept))
