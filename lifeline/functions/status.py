"""Subscription status classifier (ordered arms, first match wins)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lifeline import config as C


def subscription_status(
    churn_type: Column,
    churn_end: Column,
    calendar_date: Column,
    cancel_date: Column,
    today_utc: dt.date,
    today_local: dt.date,
) -> Column:
    """``churn_type`` / ``churn_end`` come from the churn rollup (null when no
    churn row matched); the other two from the latest snapshot row.  Arms 1,
    2 and the right side of 4 use the UTC day, the rest the local day."""
    utc = F.lit(today_utc)
    local = F.lit(today_local)
    return (
        F.when((churn_type == "voluntary") & (churn_end < utc), C.STATUS_CHURN_VOLUNTARY)
        .when((churn_type == "involuntary") & (churn_end < utc), C.STATUS_CHURN_INVOLUNTARY)
        .when(calendar_date < F.date_sub(local, 1), C.STATUS_CHURN_UNKNOWN)
        .when(
            (cancel_date < local) & (utc < F.coalesce(churn_end, F.lit(C.FAR_FUTURE))),
            C.STATUS_IN_CANCELATION,
        )
        .when(churn_end.isNull() | (churn_end >= local), C.STATUS_ACTIVE)
        .otherwise(C.STATUS_UNKNOWN)
    )
