"""Deterministic bindings of the logical inputs over the generated tables.

``orders`` becomes the daily subscription snapshot and ``events`` becomes
both the subscription-event fact and the analytics event shards.  Integer
column arithmetic only, so the DuckDB oracles can restate every rule
(see ``lifeline.plans.oracle``).  Ids, app ids and dates are invented.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeline.functions.dates import shard_suffix
from lifeline.sources.shards import ShardedEvents

# The snapshot anchor day and the invented date bases.
SNAPSHOT_ANCHOR = dt.date(2024, 1, 31)
START_BASE = dt.date(2023, 6, 1)
CANCEL_BASE = dt.date(2024, 1, 20)  # at 12:00
CYCLE_END_BASE = dt.date(2024, 1, 25)
CYCLE_START_BASE = dt.date(2023, 12, 25)

# Order status -> base group.
BASE_GROUPS = (("F", "churn"), ("O", "paying"), ("P", "trial"))

# event_id % 11 -> subscription event type, in order 0..10.
SUBSCRIPTION_EVENT_TYPES = (
    "Cancellation",
    "Request",
    "Renewal",
    "PaymentSuccessful",
    "PaymentFailed",
    "PaymentDelayedSuspension",
    "PaymentDelayedGrace",
    "InvoiceCreated",
    "Creation",
    "ChangePayment",
    "Other",
)

# Invented app ids by user_id % 4 (0 = none).
IOS_APP = "1:100:ios:aa"
ANDROID_APP = "1:100:android:bb"
WEB_APP = "G-TEST000001"


def _plus_days(base: dt.date, days: Column) -> Column:
    return F.date_add(F.lit(base), days.cast("int"))


def _lookup(key: Column, pairs) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out


def snapshot_from_orders(orders: DataFrame) -> DataFrame:
    k, o = F.col("o_custkey"), F.col("o_orderkey")
    is_churn = F.col("o_orderstatus") == "F"
    cancel_day = _plus_days(CANCEL_BASE, o % 15)
    return orders.select(
        F.concat(F.when(k % 50 == 7, "dummy").otherwise(""), k.cast("string")).alias("user_id"),
        _plus_days(SNAPSHOT_ANCHOR, -(k % 7 + o % 3)).alias("calendar_date"),
        _lookup(F.col("o_orderstatus"), BASE_GROUPS).alias("base_group"),
        _plus_days(START_BASE, k % 60 + o % 2).alias("subscription_start_date"),
        F.when(
            o % 3 == 0,
            cancel_day.cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS"),
        ).alias("subscription_cancel_dts"),
        F.when(o % 13 != 0, _plus_days(CYCLE_START_BASE, (k * 7) % 15)).alias(
            "billing_cycle_start_date"
        ),
        _plus_days(CYCLE_END_BASE, (k * 7) % 15 + (o % 2) * 2).alias("billing_cycle_end_date"),
        F.when(~is_churn | (k % 5 == 0), F.lit(None).cast("string"))
        .when(k % 5 < 3, "voluntary")
        .otherwise("involuntary")
        .alias("churn_type"),
        (o % 24 + 1).cast("long").alias("subscription_month"),
        F.when(o % 20 == 0, F.concat(F.lit("GC"), o.cast("string"))).alias("gift_card_code"),
        F.when(o % 4 != 0, F.col("o_orderpriority")).alias("payment_vendor"),
    )


def subscription_events_from_events(events: DataFrame) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    return events.select(
        e.alias("event_id"),
        u.cast("string").alias("user_id"),
        _lookup(e % 11, enumerate(SUBSCRIPTION_EVENT_TYPES)).alias("event_type"),
        F.col("ts").alias("event_ts"),
        F.concat(F.lit("S"), (u * 10 + e % 3).cast("string")).alias("subscription_id"),
        F.col("event_type").alias("offer_type"),
    )


def analytics_from_events(events: DataFrame, key_prefix: str) -> ShardedEvents:
    e, u = F.col("event_id"), F.col("user_id")
    app = (
        F.when((u % 4 == 0) | (e % 5 == 0), F.lit(None).cast("string"))
        .when(u % 4 == 1, IOS_APP)
        .when(u % 4 == 2, ANDROID_APP)
        .otherwise(WEB_APP)
    )
    pseudo = F.when(
        (u % 17 != 0) & (e % 3 != 0),
        F.upper(F.md5(F.concat(u.cast("string"), F.lit("-"), (e % 2).cast("string")))),
    )
    df = events.select(
        e.alias("event_id"),
        F.sha2(F.concat(F.lit(key_prefix), u.cast("string")), 256).alias("user_id"),
        pseudo.alias("user_pseudo_id"),
        F.col("ts").alias("event_timestamp"),
        F.struct(app.alias("firebase_app_id")).alias("app_info"),
        shard_suffix(F.col("ts")).alias("suffix"),
    )
    return ShardedEvents(df, derived_from="event_timestamp")
