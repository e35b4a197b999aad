"""Greatest text per group: any texts, no sort of raw rows, and the churn rollup on open types."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_plans import plan

from lifeline.config import SyncConfig
from lifeline.operators import greatest, state
from lifeline.operators.greatest import greatest_text

CFG = SyncConfig()
SCHEMA = (
    "user_id string, calendar_date date, base_group string, subscription_start_date date, "
    "subscription_cancel_dts timestamp_ntz, billing_cycle_start_date date, billing_cycle_end_date date, churn_type string"
)
FEW = [None, "voluntary", "involuntary", "winback", "", "Voluntary", "vol\x00", "é", "zz", "漢"]


def _rows(seed, types, n=600, users=40):
    rng = random.Random(seed)
    day = lambda k: CFG.today_local - dt.timedelta(days=k)
    return [
        (f"u{rng.randint(0, users)}", day(rng.randint(-1, 9)), rng.choice(["churn", "churn", "paying", None]), day(300 + rng.randint(0, 1)),
         None, None, rng.choice([None, day(rng.randint(-20, 20))]), rng.choice(types))
        for _ in range(n)
    ]


def _expected(rows):
    """The rollup over churn rows through today, in plain Python."""
    groups = {}
    for user, day, group, start, _, _, cycle, kind in rows:
        if group == "churn" and day <= CFG.today_local:
            groups.setdefault((user, start), []).append((cycle, kind, day if kind == "involuntary" else cycle))
    best = lambda values, key=None: max((v for v in values if v is not None), default=None, key=key)
    return {
        k: (best(c for c, _, _ in v), best((t for _, t, _ in v), key=lambda t: t.encode()), best(e for _, _, e in v)) for k, v in groups.items()
    }


def _got(df):
    return {(r[0], r[1]): (r["billing_cycle_end_date"], r["churn_type"], r["subscription_end_date"]) for r in df.collect()}


MANY = [f"type {k}" * (1 + k % 5) for k in range(200)] + [None, "x" * 3_000]


@pytest.mark.parametrize("types", [FEW, MANY, ["y" * 2_000, "voluntary"], [None]], ids=["few", "many", "long", "none"])
def test_churn_rollup_takes_any_type(spark, types):
    rows = _rows(len(types), types)
    snapshot = spark.createDataFrame(rows, SCHEMA).repartition(5)
    whole = state.churn_rollup(snapshot, CFG)
    assert whole.columns == list(state.CHURN_COLUMNS)
    assert _got(whole) == _expected(rows)
    through = CFG.today_local - dt.timedelta(days=3)
    stored = state.churn_state(snapshot, CFG, through=through)
    assert _got(state.churn_rollup(snapshot, CFG, stored, through)) == _expected(rows)
    assert _got(state.churn_rollup(snapshot, CFG, whole, CFG.today_local)) == _expected(rows)


def test_an_unlisted_type_is_not_voluntary(spark):
    """A greater type than 'voluntary' wins, and the status falls through to later arms."""
    today, ago = CFG.today_local, CFG.today_local - dt.timedelta(days=1)
    start = dt.date(2023, 1, 1)
    rows = [("u", ago, "churn", start, None, None, ago, t) for t in ("voluntary", "winback")]
    rows.append(("u", today, "paying", start, None, None, ago, None))
    got = state.subscription_state(spark.createDataFrame([(*r[:7], r[7], 1, None, None) for r in rows], SCHEMA + ", subscription_month int, gift_card_code string, payment_vendor string"), CFG)
    assert [r["subscription_status"] for r in got.collect()] == []  # its day is after the churn's end
    rows[-1] = ("u", ago, "paying", start, None, None, ago, None)
    frame = spark.createDataFrame([(*r, 1, None, None) for r in rows], SCHEMA + ", subscription_month int, gift_card_code string, payment_vendor string")
    assert [r["subscription_status"] for r in state.subscription_state(frame, CFG).collect()] == ["unknown"]


def test_raw_rows_are_folded_by_hash(spark):
    snapshot = spark.createDataFrame(_rows(1, FEW), SCHEMA)
    assert "SortAggregate" not in plan(state.churn_rollup(snapshot, CFG))
    folded = plan(state.churn_rollup(spark.createDataFrame(_rows(2, MANY), SCHEMA), CFG))
    # above the texts' bound the raw rows meet a hash aggregate first
    scan, first = folded.index("Scan "), folded.index("HashAggregate")
    assert scan >= 0 and first >= 0 and folded.count("Keys [3]") >= 2


def test_texts_added_while_reading_are_refused(spark, monkeypatch):
    df = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, t string")
    monkeypatch.setattr(greatest, "distinct_texts", lambda *_: ["x"])
    with pytest.raises(PySparkException, match="texts were added"):
        greatest_text(df, ["k"], "t").collect()


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, t string, n int")
    assert greatest_text(df, ["k"], "t", n=F.col("n")).count() == 0
