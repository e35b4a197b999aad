"""The three inputs of a run, as one value passed to the jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructField, StructType

from lifeline.config import SyncConfig
from lifeline.sources import bindings
from lifeline.sources.schemas import (
    EVENT_DAY,
    ANALYTICS_EVENT_SCHEMA,
    SNAPSHOT_SCHEMA,
    SUBSCRIPTION_EVENT_SCHEMA,
    conform,
)
from lifeline.sources.shards import ShardedEvents


@dataclass(frozen=True)
class Inputs:
    snapshot: DataFrame
    subscription_events: DataFrame
    analytics: ShardedEvents

    @classmethod
    def from_frames(
        cls, snapshot: DataFrame, subscription_events: DataFrame, analytics: DataFrame
    ) -> "Inputs":
        """DataFrames from any source (a warehouse connector, a table):
        columns are selected and cast to the declared schemas, zoned
        timestamps become UTC wall time."""
        return _from_frames(snapshot, subscription_events, analytics)

    @classmethod
    def read(
        cls,
        spark: SparkSession,
        snapshot_path: str,
        subscription_events_path: str,
        analytics_path: str,
        events_by_day: bool = False,
    ) -> "Inputs":
        """Production layout: two Parquet facts and a suffix-partitioned
        analytics dataset.  ``events_by_day``: the subscription events are
        partitioned by ``event_day``, the UTC date of ``event_ts``, and a
        local day reads only the one or two folders that it touches."""
        snap = spark.read.schema(SNAPSHOT_SCHEMA).parquet(snapshot_path)
        wanted = StructType([*SUBSCRIPTION_EVENT_SCHEMA, *([StructField(EVENT_DAY, DateType())] if events_by_day else [])])
        subs = spark.read.schema(wanted).parquet(subscription_events_path)
        return cls(
            conform(snap, SNAPSHOT_SCHEMA),
            conform(subs, wanted),
            ShardedEvents.read(spark, analytics_path),
        )


def _from_frames(snapshot: DataFrame, subscription_events: DataFrame, analytics: DataFrame) -> Inputs:
    return Inputs(
        conform(snapshot, SNAPSHOT_SCHEMA),
        conform(subscription_events, SUBSCRIPTION_EVENT_SCHEMA),
        ShardedEvents(conform(analytics, ANALYTICS_EVENT_SCHEMA)),
    )


def load_testdata(spark: SparkSession, sf_dir: str, cfg: SyncConfig | None = None) -> Inputs:
    """Bind the generated ``orders`` and ``events`` tables under ``sf_dir``."""
    cfg = cfg or SyncConfig()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return Inputs(
        bindings.snapshot_from_orders(orders),
        bindings.subscription_events_from_events(events),
        bindings.analytics_from_events(events, cfg.user_key_prefix),
    )
