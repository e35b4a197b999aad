"""A third of all events belong to one user: the event job (chunking, identity, batching) still matches the SQL oracle exactly."""

import duckdb
from pyspark.sql import functions as F

from folders import SF_MID
from lifeline.config import SyncConfig
from lifeline.plans import events_job
from lifeline.plans.oracle import ctes
from lifeline.sources import bindings
from lifeline.sources.inputs import Inputs
from tools.check_oracles import frame_hash

HOT = 7
CFG = SyncConfig(max_events_per_payload=5)


def skewed_spark(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(HOT).cast("long"))
                       .otherwise(F.col("user_id")))
    orders = spark.read.parquet(f"{SF_MID}/orders.parquet")
    return Inputs(
        bindings.snapshot_from_orders(orders),
        bindings.subscription_events_from_events(ev),
        bindings.analytics_from_events(ev, CFG.user_key_prefix),
    )


def skewed_duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{SF_MID}/orders.parquet')")
    con.execute(
        f"""CREATE VIEW events AS SELECT event_id, ts,
              CASE WHEN event_id % 3 = 0 THEN {HOT} ELSE user_id END AS user_id,
              event_type, value, props
            FROM read_parquet('{SF_MID}/events.parquet')"""
    )
    return con


def test_hot_user_event_job_matches_oracle(spark):
    inp = skewed_spark(spark)
    con = skewed_duck()
    payloads = events_job.event_payloads(inp, CFG).toPandas()
    hot_rows = payloads[payloads["user_id"] == payloads["user_id"].value_counts().idxmax()]
    assert hot_rows["chunk"].nunique() > 1
    assert payloads["n_events"].max() <= CFG.max_events_per_payload
    want = con.execute(ctes(CFG) + " SELECT app_id, user_id, chunk, n_events, payload_json FROM payload_events").df()
    got = payloads.astype({"chunk": "int64", "n_events": "int64"})
    assert frame_hash(got) == frame_hash(want)

    batches = events_job.event_batches(inp, CFG).toPandas().astype({"bucket": "int64"})
    want_b = con.execute(ctes(CFG) + " SELECT * FROM batch_events").df()
    assert frame_hash(batches) == frame_hash(want_b)
