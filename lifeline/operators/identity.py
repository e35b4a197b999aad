"""First-touch identity of analytics users.

For each hashed analytics user: the first non-null client (pseudo) id and
the app id of the very first event (a null there falls back to the default
app id).  "First" is by (event_timestamp, event_id), the id breaking ties.

An event's place in that order is one decimal number, its ``key``: the
timestamp's microseconds times 2^65 plus the event id (nulls first), so a
minimum has a fixed width.  Raw events are folded per (user, client id, app id)
to their smallest key; a user has few of those, and only they are reduced to the
per-user state: two structs, the smallest ``(key, value)`` (for the client id:
over events that have one).

* Both folds are plain aggregates with a map-side part, the first one by hash,
  without sorting raw events: a user owning a third of all events reaches the
  shuffle as a few rows per map task;
* states of disjoint shard ranges merge exactly (minimum of minima), so
  identity can be stored rather than rescanned: a cumulative table of one
  row per user updated with new shards only (``fold_shards``), or a
  suffix-partitioned table of per-day states (``day_states``) from which
  any shard range is merged (``range_state``).

Joining this one row per user to the subscription side replaces window
functions over the join product.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeline.config import SyncConfig
from lifeline.operators.key_filter import bitmap_bits, key_bitmap, may_have_key
from lifeline.sources.shards import ShardedEvents


#: The key of an event is micros * KEY_STEP + id - least id + 1.
KEY_STEP = 2**65
_LEAST_ID = -(2**63)
#: Stands for a null timestamp, before all others.
_NO_TIME = -(2**59)


def event_key() -> Column:
    """The place of an event by (event_timestamp, event_id), nulls first."""
    since = F.col("event_timestamp") - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    micros = (since.cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("decimal(18,0)")
    whole = lambda number, digits: F.lit(Decimal(number)).cast(f"decimal({digits},0)")
    event = F.coalesce(F.col("event_id").cast("decimal(19,0)") - whole(_LEAST_ID - 1, 19), whole(0, 1))
    place = F.coalesce(micros, whole(_NO_TIME, 18)).cast("decimal(18,0)") * whole(KEY_STEP, 20) + event
    return place.cast("decimal(38,0)")


def _fold(analytics: DataFrame, *by: str) -> DataFrame:
    """The mergeable state per ``by``: ``first_client`` and ``first_app`` structs."""
    rows = analytics.select(*by, F.col("user_pseudo_id").alias("client"), F.col("app_info.firebase_app_id").alias("app"), event_key().alias("key"))
    few = rows.groupBy(*by, "client", "app").agg(F.min("key").alias("key"))
    first = lambda value: F.struct("key", F.col(value).alias("value"))
    return few.groupBy(*by).agg(
        F.min(F.when(F.col("client").isNotNull(), first("client"))).alias("first_client"), F.min(first("app")).alias("first_app")
    )


def first_touch_state(analytics: DataFrame) -> DataFrame:
    """``user_id``, ``first_client`` and ``first_app`` structs (mergeable)."""
    return _fold(analytics, "user_id")


def merge_first_touch(*states: DataFrame) -> DataFrame:
    """Exact merge of states built from disjoint (or overlapping) events."""
    union = reduce(lambda a, b: a.unionByName(b), states)
    return union.groupBy("user_id").agg(
        F.min("first_client").alias("first_client"), F.min("first_app").alias("first_app")
    )


def finalize_first_touch(state: DataFrame, cfg: SyncConfig) -> DataFrame:
    """``user_id`` (hashed), ``client_id`` (may be null), ``app_id``."""
    return state.select(
        "user_id",
        F.col("first_client.value").alias("client_id"),
        F.coalesce(F.col("first_app.value"), F.lit(cfg.default_app_id)).alias("app_id"),
    )


def key_filter(
    keys: DataFrame | None, cfg: SyncConfig, n_keys: int | None = None
) -> Callable[[DataFrame], DataFrame]:
    """A filter keeping the rows whose ``user_id`` may be in ``keys``: a bitmap
    of at most ``cfg.identity_filter_bits`` bits, broadcast, so nothing is
    shuffled.  Some other users pass; the inner join after the aggregate
    drops them.  The distinct keys are counted once (``n_keys`` if the caller
    did), however many frames the filter is applied to."""
    if keys is None:
        return lambda df: df
    keys = keys.select("user_id").distinct()
    bits = bitmap_bits(keys.count() if n_keys is None else n_keys, cfg.identity_filter_bits)
    bitmap = key_bitmap(keys, "user_id", bits)
    return lambda df: may_have_key(df, "user_id", bitmap, bits)


def first_touch(
    analytics: DataFrame,
    cfg: SyncConfig,
    keys: DataFrame | None = None,
    n_keys: int | None = None,
) -> DataFrame:
    """First-touch identity over ``analytics``, optionally only for ``keys``
    and some users beside them (see ``key_filter``)."""
    only_keys = key_filter(keys, cfg, n_keys)
    return finalize_first_touch(first_touch_state(only_keys(analytics)), cfg)


def fold_shards(
    state: DataFrame | None,
    analytics: ShardedEvents,
    after: str | None,
    through: str,
) -> DataFrame:
    """Identity state through shard ``through``: ``state`` (covering shards
    up to ``after``) merged with the shards after ``after``.  With no prior
    state, all shards up to ``through``."""
    fresh = first_touch_state(analytics.between(after, through, low_inclusive=False))
    return fresh if state is None else merge_first_touch(state, fresh)


def write_state(state: DataFrame, path: str) -> None:
    """Store an identity state (one row per user) as a new table version;
    the next run reads it back with ``spark.read.parquet(path)``."""
    state.write.mode("errorifexists").parquet(path)


# per-day states: one row per (shard, user), kept as a suffix-partitioned table
_FIRST = "struct<key: decimal(38,0), value: string>"
DAY_STATE_DDL = f"user_id string, first_client {_FIRST}, first_app {_FIRST}, suffix string"


def day_states(analytics: DataFrame) -> DataFrame:
    """Identity state of every (shard, user): a one-day summary that merges
    exactly with other days (``range_state``)."""
    return _fold(analytics, "suffix", "user_id")


def write_day_states(states: DataFrame, path: str) -> None:
    """Store complete days in the day-state table (one folder per shard); a
    day that is written again replaces its folder, others stay."""
    states.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("suffix").parquet(path)


def read_day_states(spark, path: str) -> DataFrame:
    """The day-state table with the suffix kept as a string."""
    return spark.read.schema(DAY_STATE_DDL).parquet(path)


def range_state(
    analytics: ShardedEvents,
    lo: str,
    hi: str,
    stored: DataFrame | None = None,
    stored_through: str | None = None,
) -> DataFrame:
    """Identity state over shards ``lo`` ..= ``hi``: stored day states for
    the shards up to ``stored_through`` (partition-pruned), raw events for
    the shards after it."""
    if stored is None or stored_through is None or stored_through < lo:
        return first_touch_state(analytics.between(lo, hi))
    upto = min(hi, stored_through)
    old = stored.where(F.col("suffix").between(F.lit(lo), F.lit(upto))).drop("suffix")
    if upto >= hi:
        return merge_first_touch(old)
    fresh = first_touch_state(analytics.between(upto, hi, low_inclusive=False))
    return merge_first_touch(old, fresh)
