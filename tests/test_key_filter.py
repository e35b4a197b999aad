"""The bitmap passes every key, few others, and is bounded; event keys keep the order of events."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lifeline.operators.identity import event_key, first_touch_state, merge_first_touch
from lifeline.operators.key_filter import PIECE_BITS, bitmap_bits, key_bitmap, may_have_key


def test_bits_are_bounded():
    assert bitmap_bits(0, 1 << 27) == PIECE_BITS
    assert bitmap_bits(10**6, 1 << 27) == 1 << 24
    assert bitmap_bits(10**12, 1 << 27) == 1 << 27
    assert bitmap_bits(10**12, 0) == PIECE_BITS


@pytest.mark.parametrize("bits", [PIECE_BITS, 1 << 20])
def test_every_key_passes_and_few_others(spark, bits):
    keys = spark.range(0, 8_000, 4).select(F.concat(F.lit("u"), "id").alias("user_id")).union(spark.createDataFrame([(None,)], "user_id string"))
    rows = spark.range(8_000).select(F.concat(F.lit("u"), "id").alias("user_id"), "id").union(spark.createDataFrame([(None, -1)], "user_id string, id long"))
    got = {r["id"] for r in may_have_key(rows, "user_id", key_bitmap(keys, "user_id", bits), bits).collect()}
    assert set(range(0, 8_000, 4)) <= got and -1 not in got
    assert len(got) - 2_000 <= 6_000 * 1.5 * 2_000 / bits + 5


def test_no_keys_pass_nothing(spark):
    rows = spark.range(10).select(F.col("id").cast("string").alias("user_id"))
    none = key_bitmap(rows.limit(0), "user_id", PIECE_BITS)
    assert may_have_key(rows, "user_id", none, PIECE_BITS).count() == 0


EVENTS = "user_id string, user_pseudo_id string, event_timestamp timestamp_ntz, app_info struct<firebase_app_id: string>, event_id bigint"


@pytest.mark.parametrize("zone", ["UTC", "America/St_Johns"])
def test_event_keys_order_as_events(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = [None, dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 2, 30, 0, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999)]
        ids = [None, -(2**63), -1, 0, 1, 2**63 - 1]
        rows = [("u", None, t, (None,), i) for t in times for i in ids]
        got = spark.createDataFrame(rows, EVENTS).select("event_timestamp", "event_id", event_key().alias("key")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    keys = [r["key"] for r in got]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_states_against_plain_python(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(800):
        t = rng.choice([None] + [dt.datetime(2024, 1, 1, 0, 0, rng.randint(0, 20)) for _ in range(9)])
        rows.append((f"u{rng.randint(0, 30)}", rng.choice([None, "c1", "c2", "c3"]), t, rng.choice([None, ("a",), ("b",), (None,)]), rng.randint(0, 10**6)))
    order = lambda e: (e[2] is not None, e[2] or dt.datetime.min, e[4])
    want = {}
    for e in sorted(rows, key=order):
        client, app = want.setdefault(e[0], [None, []])
        want[e[0]] = [client or e[1], app or [e[3][0] if e[3] else None]]
    frame = spark.createDataFrame(rows, EVENTS).repartition(4)
    halves = [frame.where(F.col("event_id") % 2 == k) for k in range(2)]
    for state in (first_touch_state(frame), merge_first_touch(*map(first_touch_state, halves))):
        got = {r["user_id"]: [r["first_client"] and r["first_client"]["value"], [r["first_app"]["value"]]] for r in state.collect()}
        assert got == want
