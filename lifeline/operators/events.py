"""One local day of subscription events, keyed by the hashed user."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeline.config import SyncConfig
from lifeline.functions.dates import local_date
from lifeline.functions.keys import hashed_user_key
from lifeline.sources.schemas import EVENT_DAY


def local_day_bounds(day: dt.date, zone: str) -> tuple[dt.datetime, dt.datetime]:
    """UTC wall-clock [start, end) of a local calendar day (DST aware)."""
    tz = ZoneInfo(zone)
    start = dt.datetime.combine(day, dt.time(), tz).astimezone(dt.timezone.utc)
    end = dt.datetime.combine(day + dt.timedelta(days=1), dt.time(), tz).astimezone(
        dt.timezone.utc
    )
    return start.replace(tzinfo=None), end.replace(tzinfo=None)


def events_of_day(sub_events: DataFrame, cfg: SyncConfig, day: dt.date | None = None) -> DataFrame:
    """Distinct (hashed user, type, local date, subscription, offer) of the
    events whose local date is ``day`` (default: yesterday, local).

    The day test is also stated as a UTC timestamp range, which reaches the
    Parquet scan as a pushed filter; the local-date test keeps it exact.
    Events stored by UTC day (``EVENT_DAY``) are cut by partition first.
    """
    day = day or cfg.yesterday_local
    lo, hi = local_day_bounds(day, cfg.zone)
    ts = F.col("event_ts")
    in_day = (
        (ts >= F.lit(lo.isoformat(" ")).cast("timestamp_ntz"))
        & (ts < F.lit(hi.isoformat(" ")).cast("timestamp_ntz"))
        & (local_date(ts, cfg.zone) == F.lit(day))
    )
    if EVENT_DAY in sub_events.columns:
        last = (hi - dt.timedelta(microseconds=1)).date()
        in_day = F.col(EVENT_DAY).between(F.lit(lo.date()), F.lit(last)) & in_day
    return (
        sub_events.where(in_day)
        .select(
            hashed_user_key(F.col("user_id"), cfg.user_key_prefix).alias("user_id"),
            "event_type",
            F.lit(day).alias("date_of_change"),
            "subscription_id",
            "offer_type",
        )
        .distinct()
    )
