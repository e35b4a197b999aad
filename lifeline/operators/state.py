"""Current subscription state per user from the daily snapshot.

latest entry (argmax day per user, ties kept) -> churn rollup per
(user, start) -> left join on (user, billing cycle end) with a theta
residual -> status classifier -> DISTINCT.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeline import config as C
from lifeline.config import SyncConfig
from lifeline.functions.status import subscription_status
from lifeline.operators.greatest import greatest_text

SB_COLUMNS = (
    "user_id",
    "calendar_date",
    "base_group",
    "subscription_start_date",
    "subscription_cancel_dts",
    "billing_cycle_start_date",
    "billing_cycle_end_date",
)
CHURN_KEYS = ["user_id", "subscription_start_date"]
CHURN_COLUMNS = (*CHURN_KEYS, "billing_cycle_end_date", "churn_type", "subscription_end_date")
ATTRIBUTE_COLUMNS = ("subscription_month", "gift_card_code", "payment_vendor")


def exclude_test_users(df: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Drop test users (id starts with the test prefix); a null id is dropped
    too, as ``NOT LIKE`` on null is not true."""
    return df.where(~F.col("user_id").startswith(cfg.test_user_prefix))


def lookback_start(cfg: SyncConfig) -> dt.date:
    return cfg.today_local - dt.timedelta(days=cfg.snapshot_lookback_days)


def _latest_between(snapshot: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Non-churn rows on each user's latest non-churn day from ``first`` through ``last``.

    Group max, then an equi-join back on (user, day).  The max is computed
    with partial aggregation, so a user holding a large share of the rows is
    folded map-side; the day bounds are stated on both sides (implied by
    the equality) so both scans are filtered.  A single day needs neither.
    """
    paying = snapshot.where((F.col("base_group") != "churn") & F.col("calendar_date").between(F.lit(first), F.lit(last)))
    if first >= last:
        return paying.where(F.col("user_id").isNotNull())
    latest = paying.groupBy("user_id").agg(F.max("calendar_date").alias("calendar_date"))
    return paying.join(latest, ["user_id", "calendar_date"], "inner").select(snapshot.columns)


def latest_entry(
    snapshot: DataFrame, cfg: SyncConfig, stored: DataFrame | None = None, stored_through: dt.date | None = None, through: dt.date | None = None
) -> DataFrame:
    """Non-churn snapshot rows on each user's latest non-churn day within the
    lookback before ``through`` (today by default); every row of that day is
    kept (ties kept).

    With ``stored``, this result as of an earlier day ``stored_through``, only
    the days after it are read: users who have rows there replace theirs
    (an anti-join), the others keep them while they are within the lookback.
    """
    through = through or cfg.today_local
    first = through - dt.timedelta(days=cfg.snapshot_lookback_days)
    if stored is None:
        return _latest_between(snapshot, first, through)
    if stored_through is None or stored_through > through:
        raise ValueError(f"a stored latest entry must end by {through}")
    fresh = _latest_between(snapshot, max(first, stored_through + dt.timedelta(days=1)), through)
    older = stored.select(snapshot.columns).where(F.col("calendar_date") >= F.lit(first))
    return older.join(fresh.select("user_id").distinct(), "user_id", "left_anti").select(snapshot.columns).unionByName(fresh)


def churn_state(snapshot: DataFrame, cfg: SyncConfig, after: dt.date | None = None, through: dt.date | None = None) -> DataFrame:
    """Per (user, start) maxima over churn rows of the days after ``after``
    through ``through`` (today by default): cycle end, churn type (any text, the
    greatest in byte order) and end date (the snapshot day for involuntary
    rows, the cycle end otherwise).

    Raw rows are folded by a hash aggregate (``greatest_text``).  States of
    several day ranges merge exactly (``merge_churn``), so a day's run may read
    a stored one and new days only.
    """
    day = F.col("calendar_date")
    days = day <= F.lit(through or cfg.today_local)
    if after is not None:
        days = days & (day > F.lit(after))
    end = F.when(F.col("churn_type") == "involuntary", day).otherwise(F.col("billing_cycle_end_date"))
    return greatest_text(
        snapshot.where((F.col("base_group") == "churn") & days),
        CHURN_KEYS,
        "churn_type",
        billing_cycle_end_date=F.col("billing_cycle_end_date"),
        subscription_end_date=end,
    ).select(*CHURN_COLUMNS)


def merge_churn(*states: DataFrame) -> DataFrame:
    """Exact merge of churn states (a maximum of maxima; overlaps do no harm)."""
    maxima = {c: F.col(c) for c in ("billing_cycle_end_date", "subscription_end_date")}
    return greatest_text(reduce(DataFrame.unionByName, states), CHURN_KEYS, "churn_type", **maxima).select(*CHURN_COLUMNS)


def churn_rollup(
    snapshot: DataFrame, cfg: SyncConfig, stored: DataFrame | None = None, stored_through: dt.date | None = None
) -> DataFrame:
    """Per (user, start) over churn rows through today: latest cycle end, the
    greatest churn type ('voluntary' > 'involuntary') and the end date.  With
    a ``stored`` churn state through day ``stored_through``, only later days
    are read; a state that goes past today is refused."""
    if stored is None:
        return churn_state(snapshot, cfg)
    if stored_through is None or stored_through > cfg.today_local:
        raise ValueError("a stored churn state must end by today")
    if stored_through == cfg.today_local:
        return stored.select(*CHURN_COLUMNS)
    return merge_churn(stored, churn_state(snapshot, cfg, after=stored_through))


def snapshot_with_churn(
    latest: DataFrame, churn: DataFrame, simplified: bool = True
) -> DataFrame:
    """Left join of latest rows to the churn rollup on user and cycle end,
    with the churn end on or after the row's start, then keep rows whose day
    is not after the churn end.

    ``simplified=False`` keeps the extra ``OR start > churn_end`` arm of the
    original filter; the join already demands ``churn_end >= start``, so the
    arm is never true (a matched row fails it, an unmatched one is null).
    """
    sb, c = latest.alias("sb"), churn.alias("c")
    on = (
        (F.col("sb.user_id") == F.col("c.user_id"))
        & (F.col("c.subscription_end_date") >= F.col("sb.subscription_start_date"))
        & (F.col("c.billing_cycle_end_date") == F.col("sb.billing_cycle_end_date"))
    )
    keep = F.col("sb.calendar_date") <= F.coalesce(
        F.col("c.subscription_end_date"), F.lit(C.FAR_FUTURE)
    )
    if not simplified:
        keep = keep | (F.col("sb.subscription_start_date") > F.col("c.subscription_end_date"))
    carried = [c for c in latest.columns]
    return (
        sb.join(c, on, "left")
        .where(keep)
        .select(
            *[F.col(f"sb.{name}") for name in carried],
            F.col("c.churn_type").alias("churn_type"),
            F.col("c.subscription_end_date").alias("churn_end_date"),
        )
    )


def subscription_state(
    snapshot: DataFrame,
    cfg: SyncConfig,
    simplified: bool = True,
    with_attributes: bool = False,
    stored_churn: DataFrame | None = None,
    churn_through: dt.date | None = None,
    stored_latest: DataFrame | None = None,
    latest_through: dt.date | None = None,
) -> DataFrame:
    """One row per distinct subscription state of each non-test user.

    ``stored_churn`` (a churn state through day ``churn_through``) and
    ``stored_latest`` (the latest entries as of day ``latest_through``) save
    reading the snapshot of those days.

    ``with_attributes`` also carries month, gift card and vendor (computed
    by the original query, then dropped before the payload stage).
    """
    wanted = SB_COLUMNS + (ATTRIBUTE_COLUMNS if with_attributes else ())
    snap = exclude_test_users(snapshot.select(*wanted, "churn_type"), cfg)
    if stored_latest is not None:
        stored_latest = exclude_test_users(stored_latest, cfg)
    latest = latest_entry(snap.drop("churn_type"), cfg, stored_latest, latest_through)
    churn = churn_rollup(snap.select(
        "user_id", "calendar_date", "base_group", "subscription_start_date",
        "billing_cycle_end_date", "churn_type",
    ), cfg, exclude_test_users(stored_churn, cfg) if stored_churn is not None else None, churn_through)
    rows = snapshot_with_churn(latest, churn, simplified)
    cancel_date = F.to_date(F.col("subscription_cancel_dts"))
    out = [
        F.col("user_id"),
        F.col("subscription_start_date"),
        cancel_date.alias("subscription_cancel_date"),
        F.coalesce(F.col("billing_cycle_start_date"), F.lit(C.NO_DATE)).alias(
            "subscription_next_renewal_date"
        ),
        F.coalesce(
            F.col("churn_end_date"), F.col("billing_cycle_end_date"), F.lit(C.NO_DATE)
        ).alias("subscription_end_date"),
        subscription_status(
            F.col("churn_type"),
            F.col("churn_end_date"),
            F.col("calendar_date"),
            cancel_date,
            cfg.today_utc,
            cfg.today_local,
        ).alias("subscription_status"),
    ]
    if with_attributes:
        out += [
            F.col("subscription_month").cast("long").alias("subscription_month"),
            F.col("gift_card_code"),
            F.coalesce(F.col("payment_vendor"), F.lit("unknown")).alias(
                "subscription_payment_vendor"
            ),
        ]
    return rows.select(*out).distinct()


def status_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("subscription_status").agg(F.count(F.lit(1)).alias("n_states"))
