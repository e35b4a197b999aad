"""Outbound payloads and their wire bodies.

A payload is the struct the batches carry; the wire body is what is POSTed:
the payload without ``URL`` and ``app_id``, the client id named
``app_instance_id`` on mobile endpoints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeline.config import SyncConfig
from lifeline.functions.routing import is_mobile_endpoint
from lifeline.operators.numbering import number_in_groups

VALUE = lambda c: F.struct(c.alias("value"))

USER_PROPERTIES = (
    "subscription_status",
    "subscription_start_date",
    "subscription_end_date",
    "subscription_cancel_date",
    "subscription_renewal_date",
)

_STR = T.StringType()
_PROPS = T.StructType(
    [T.StructField(p, T.StructType([T.StructField("value", _STR)])) for p in USER_PROPERTIES]
)
STATE_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("URL", _STR),
        T.StructField("app_id", _STR),
        T.StructField("client_id", _STR),
        T.StructField("user_id", _STR),
        T.StructField("user_properties", _PROPS),
        T.StructField(
            "events",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", _STR),
                        T.StructField(
                            "params", T.StructType([T.StructField("offline_event", _STR)])
                        ),
                    ]
                )
            ),
        ),
    ]
)
EVENT_PARAMS = T.StructType(
    [
        T.StructField("offline_event", _STR),
        T.StructField("offer_type", _STR),
        T.StructField("subscription_id", _STR),
    ]
)
EVENT_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("URL", _STR),
        T.StructField("app_id", _STR),
        T.StructField("client_id", _STR),
        T.StructField("user_id", _STR),
        T.StructField(
            "events",
            T.ArrayType(
                T.StructType([T.StructField("name", _STR), T.StructField("params", EVENT_PARAMS)])
            ),
        ),
    ]
)


def state_payloads(projected: DataFrame, cfg: SyncConfig) -> DataFrame:
    """One payload per state row: five ``{value}`` user properties and one
    fixed state event.  (The list of fixed events is not repeated once per
    row of the same user: that would emit every pair of a user's rows.)"""
    event = F.struct(
        F.lit(cfg.state_event_name).alias("name"),
        F.struct(F.lit("true").alias("offline_event")).alias("params"),
    )
    payload = F.struct(
        F.col("mp_url").alias("URL"),
        F.col("app_id"),
        F.col("client_id"),
        F.col("hashed_user_id").alias("user_id"),
        F.struct(*[VALUE(F.col(p)).alias(p) for p in USER_PROPERTIES]).alias("user_properties"),
        F.array(event).alias("events"),
    )
    return projected.select(
        "app_id",
        F.col("hashed_user_id").alias("user_id"),
        F.to_json(payload).alias("payload_json"),
    )


def number_user_events(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_rn``, the place of each event among its user's; a user of
    any size is numbered over many tasks, and the result is checkpointed."""
    return number_in_groups(rows, "user_id", ["event_custom_type", "subscription_id", "offer_type", "event_type"], "_rn")


def chunk_user_events(rows: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Cut each user's numbered events (numbered here if they are not) into chunks
    of at most ``cfg.max_events_per_payload`` (``_chunk``).  Chunks depend on the
    events and that size only."""
    numbered = rows if "_rn" in rows.columns else number_user_events(rows)
    return numbered.withColumn("_chunk", F.floor((F.col("_rn") - 1) / cfg.max_events_per_payload))


def user_event_lists(rows: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Per (user, chunk) the ordered list of event structs."""
    chunked = chunk_user_events(rows, cfg)
    event = F.struct(
        F.col("event_custom_type").alias("name"),
        F.struct(
            F.lit("true").alias("offline_event"),
            F.col("offer_type").alias("offer_type"),
            F.col("subscription_id").alias("subscription_id"),
        ).alias("params"),
    )
    keys = ["user_id", "app_id", "client_id", "mp_url", "_chunk"]
    return chunked.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("_rn").alias("rn"), event.alias("e")))),
            lambda x: x["e"],
        ).alias("events")
    )


def event_payloads(rows: DataFrame, cfg: SyncConfig) -> DataFrame:
    """One payload per (user, chunk) listing that chunk's events."""
    lists = user_event_lists(rows, cfg)
    payload = F.struct(
        F.col("mp_url").alias("URL"),
        F.col("app_id"),
        F.col("client_id"),
        F.col("user_id"),
        F.col("events"),
    )
    return lists.select(
        "app_id",
        "user_id",
        F.col("_chunk").alias("chunk"),
        F.size("events").alias("n_events"),
        F.to_json(payload).alias("payload_json"),
    )


def wire_columns(p: Column, schema: T.StructType) -> dict[str, Column]:
    """URL, wire body, byte length and deliverability of a parsed payload
    struct ``p`` (fields as in ``schema``).

    Key order follows the original sender: the id key moves to the end on
    mobile endpoints; ``to_json`` leaves out whichever of the two is null.
    """
    names = [f.name for f in schema.fields if f.name not in ("URL", "app_id", "client_id")]
    url = p["URL"]
    mobile = is_mobile_endpoint(F.substring_index(url, "&api_secret=", 1))
    client = p["client_id"]
    body = F.to_json(
        F.struct(
            F.when(~mobile, client).alias("client_id"),
            *[p[n].alias(n) for n in names],
            F.when(mobile, client).alias("app_instance_id"),
        )
    )
    return {
        "url": url,
        "body": body,
        "deliverable": client.isNotNull() & (F.trim(client) != ""),
        "content_length": F.octet_length(body),
    }


def wire_rows(payloads: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with ``payload_json`` plus URL, wire body, byte length and
    whether the payload can be delivered (client id present, not blank)."""
    w = wire_columns(F.from_json(F.col("payload_json"), schema), schema)
    return payloads.select("*", *[c.alias(n) for n, c in w.items()])
