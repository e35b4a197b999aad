"""Event day, names, routing, chunking of hot users, wire bodies."""

import datetime as dt
import json

from pyspark.sql import functions as F

from lifeline.config import SyncConfig
from lifeline.functions.names import event_custom_type
from lifeline.functions.routing import route_columns
from lifeline.operators import payload
from lifeline.operators.events import events_of_day, local_day_bounds
from lifeline.sources.schemas import SUBSCRIPTION_EVENT_SCHEMA

CFG = SyncConfig()


def test_local_day_bounds_dst():
    lo, hi = local_day_bounds(dt.date(2024, 3, 31), "Europe/Berlin")
    assert lo == dt.datetime(2024, 3, 30, 23) and hi == dt.datetime(2024, 3, 31, 22)


def test_events_of_day_midnight_gap(spark):
    rows = [
        (1, "7", "Renewal", dt.datetime(2024, 1, 29, 23, 30), "S1", "a"),  # 00:30 local on the 30th
        (2, "7", "Renewal", dt.datetime(2024, 1, 30, 23, 30), "S1", "b"),  # 00:30 local on the 31st
        (3, "7", "Renewal", dt.datetime(2024, 1, 29, 22, 59), "S1", "c"),  # 23:59 local on the 29th
    ]
    df = spark.createDataFrame(rows, SUBSCRIPTION_EVENT_SCHEMA)
    got = [r.offer_type for r in events_of_day(df, CFG).collect()]
    assert got == ["a"]


def test_event_names(spark):
    df = spark.createDataFrame(
        [("Request",), ("Other",), (None,), ("InvoiceCreated",)], "event_type string"
    )
    got = [r.n for r in df.select(event_custom_type(F.col("event_type")).alias("n")).collect()]
    assert got == ["subs_request", "not available", "not available", "invoice_created"]


def test_route_first_match_wins(spark):
    df = spark.createDataFrame([("G-ios1",), ("1:2:ios:x",), ("1:2:android:y",), ("zzz",)], "app_id string")
    r = route_columns(F.col("app_id"), CFG)
    got = [(x.route, x.app_secret) for x in df.select(r["route"].alias("route"), r["app_secret"].alias("app_secret")).collect()]
    assert got == [("web", "secret-web"), ("ios", "secret-ios"), ("android", "secret-android"),
                   ("android", "secret-android")]


def _event_rows(spark, n_hot, n_cold):
    rows = [("hot", f"e{i:05d}", "Renewal", f"S{i}", "offer", "A", "G-x", "u") for i in range(n_hot)]
    rows += [("cold", f"e{i}", "Renewal", f"S{i}", "offer", "B", "1:ios:z", "u") for i in range(n_cold)]
    df = spark.createDataFrame(
        rows, "user_id string, k string, event_type string, subscription_id string, offer_type string, "
              "client_id string, app_id string, mp_url string")
    return df.withColumn("event_custom_type", F.lit("renewal"))


def test_chunks_of_a_hot_user_are_full_and_in_order(spark):
    cfg = SyncConfig(max_events_per_payload=25)
    rows = _event_rows(spark, 1000, 30)
    lists = payload.user_event_lists(rows, cfg).collect()
    hot = [r for r in lists if r.user_id == "hot"]
    assert [len(r.events) for r in hot] == [25] * 40
    subs = [e.params.subscription_id for r in sorted(hot, key=lambda r: r._chunk) for e in r.events]
    assert subs == sorted(f"S{i}" for i in range(1000))  # nothing dropped or doubled
    cold = [r for r in lists if r.user_id == "cold"]
    assert sorted(len(r.events) for r in cold) == [5, 25]


def test_wire_body_rename_and_drop(spark):
    p = {"URL": "https://x.invalid/mp?firebase_app_id=1:ios:z&api_secret=s", "app_id": "1:ios:z",
         "client_id": "C1", "user_id": "U", "events": []}
    w = {"URL": "https://x.invalid/mp?measurement_id=G-1&api_secret=android", "app_id": "G-1",
         "client_id": "C2", "user_id": "V", "events": []}
    blank = dict(w, client_id="")
    df = spark.createDataFrame([(json.dumps(x),) for x in (p, w, blank)], "payload_json string")
    out = payload.wire_rows(df, payload.EVENT_PAYLOAD_SCHEMA).collect()
    assert json.loads(out[0].body) == {"user_id": "U", "events": [], "app_instance_id": "C1"}
    assert list(json.loads(out[0].body)) == ["user_id", "events", "app_instance_id"]
    # secret text never decides the rename
    assert json.loads(out[1].body) == {"client_id": "C2", "user_id": "V", "events": []}
    assert [r.deliverable for r in out] == [True, True, False]
    assert out[0].content_length == len(out[0].body.encode("utf-8"))


def test_routing_matches_python_model(spark):
    import random

    rnd = random.Random(7)
    parts = ["G-", "ios", "android", "1:", ":x", "g-", "IOS", "web", "-"]
    ids = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 4))) for _ in range(600)]
    ids += [None]

    def model(app):
        if app is None:
            return "android", None
        for r in CFG.routes[:-1]:
            if r.match in app:
                return r.name, f"{CFG.endpoint_base}?{r.id_param}={app}&api_secret={r.secret_name}"
        r = CFG.routes[-1]
        return r.name, f"{CFG.endpoint_base}?{r.id_param}={app}&api_secret={r.secret_name}"

    df = spark.createDataFrame([(i, a) for i, a in enumerate(ids)], "i int, app_id string")
    r = route_columns(F.col("app_id"), CFG)
    got = {x.i: (x.route, x.mp_url) for x in df.select("i", r["route"].alias("route"), r["mp_url"].alias("mp_url")).collect()}
    assert all(got[i] == model(a) for i, a in enumerate(ids))
