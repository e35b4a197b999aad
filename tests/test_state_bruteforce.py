"""subscription_state against a plain-Python model of the query on random
small snapshots (many users share days, cycle ends and churn rows)."""

import datetime as dt
import random

import pytest

from lifeline import config as C
from lifeline.config import SyncConfig
from lifeline.operators import state
from lifeline.sources.schemas import SNAPSHOT_SCHEMA

CFG = SyncConfig()
T = CFG.today_local
D = lambda n: T + dt.timedelta(days=n)


def model(rows, cfg=CFG):
    today_utc, today_local = cfg.today_utc, cfg.today_local
    start_bound = today_local - dt.timedelta(days=cfg.snapshot_lookback_days)
    rows = [r for r in rows if r["user_id"] is not None and not r["user_id"].startswith("dummy")]
    paying = [r for r in rows if r["base_group"] is not None and r["base_group"] != "churn"
              and r["calendar_date"] >= start_bound]
    latest_day = {}
    for r in paying:
        latest_day[r["user_id"]] = max(latest_day.get(r["user_id"], r["calendar_date"]), r["calendar_date"])
    latest = [r for r in paying if r["calendar_date"] == latest_day[r["user_id"]]]
    churn = {}
    for r in rows:
        if r["base_group"] != "churn":
            continue
        k = (r["user_id"], r["subscription_start_date"])
        end = r["calendar_date"] if r["churn_type"] == "involuntary" else r["billing_cycle_end_date"]
        g = churn.setdefault(k, {"bce": None, "type": None, "end": None})
        for key, v in (("bce", r["billing_cycle_end_date"]), ("type", r["churn_type"]), ("end", end)):
            if v is not None and (g[key] is None or v > g[key]):
                g[key] = v
    out = set()
    for sb in latest:
        matches = [
            g for (u, _), g in churn.items()
            if u == sb["user_id"] and g["end"] is not None and sb["subscription_start_date"] is not None
            and g["end"] >= sb["subscription_start_date"]
            and g["bce"] is not None and g["bce"] == sb["billing_cycle_end_date"]
        ] or [None]
        for g in matches:
            ctype, cend = (g["type"], g["end"]) if g else (None, None)
            if not sb["calendar_date"] <= (cend or C.FAR_FUTURE):
                continue
            cancel = sb["subscription_cancel_dts"].date() if sb["subscription_cancel_dts"] else None
            if ctype == "voluntary" and cend is not None and cend < today_utc:
                status = C.STATUS_CHURN_VOLUNTARY
            elif ctype == "involuntary" and cend is not None and cend < today_utc:
                status = C.STATUS_CHURN_INVOLUNTARY
            elif sb["calendar_date"] < today_local - dt.timedelta(days=1):
                status = C.STATUS_CHURN_UNKNOWN
            elif cancel is not None and cancel < today_local and today_utc < (cend or C.FAR_FUTURE):
                status = C.STATUS_IN_CANCELATION
            elif cend is None or cend >= today_local:
                status = C.STATUS_ACTIVE
            else:
                status = C.STATUS_UNKNOWN
            out.add((
                sb["user_id"], sb["subscription_start_date"], cancel,
                sb["billing_cycle_start_date"] or C.NO_DATE,
                cend or sb["billing_cycle_end_date"] or C.NO_DATE,
                status,
            ))
    return out


def random_rows(seed, n):
    rnd = random.Random(seed)
    pick = lambda xs: xs[rnd.randrange(len(xs))]
    rows = []
    for _ in range(n):
        rows.append({
            "user_id": pick(["u1", "u2", "u3", "dummy9", None]),
            "calendar_date": D(-rnd.randrange(10)),
            "base_group": pick(["churn", "paying", "trial", None]),
            "subscription_start_date": pick([D(-60), D(-30), None]),
            "subscription_cancel_dts": pick([None, dt.datetime.combine(D(-rnd.randrange(4)), dt.time(23, 30))]),
            "billing_cycle_start_date": pick([None, D(-20)]),
            "billing_cycle_end_date": pick([D(-3), D(-1), D(2), None]),
            "churn_type": pick(["voluntary", "involuntary", None, "other"]),
            "subscription_month": 1, "gift_card_code": None, "payment_vendor": None,
        })
    return rows


@pytest.mark.parametrize("seed", range(12))
def test_state_matches_model(spark, seed):
    rows = random_rows(seed, 40)
    df = spark.createDataFrame([tuple(r[f.name] for f in SNAPSHOT_SCHEMA.fields) for r in rows],
                               SNAPSHOT_SCHEMA)
    got = {tuple(r) for r in state.subscription_state(df, CFG).collect()}
    assert got == model(rows)
