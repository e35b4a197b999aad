"""Run parameters.

One frozen ``SyncConfig`` carries every knob the jobs read: the as-of
instant (both clocks derive from it), the local zone, routes, batch sizing
and delivery parallelism.  Secrets are never stored: a route carries the
*name* of its secret, which the transport resolves at send time.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from zoneinfo import ZoneInfo


@dataclass(frozen=True)
class Route:
    """One outbound endpoint family; ``match`` is a case-sensitive substring
    of the app id (``None`` = default route, must come last)."""

    name: str
    match: str | None
    id_param: str
    secret_name: str


# Routing rules of the collection endpoint, checked in this
# order, first match wins.
#   app id contains "G-"  -> web,     id parameter "measurement_id"
#   app id contains "ios" -> ios,     id parameter "firebase_app_id"
#   anything else         -> android, id parameter "firebase_app_id"
# (Whether the client id is sent as app_instance_id is decided on the
# endpoint text: it contains "ios" or "android".)
DEFAULT_ROUTES: tuple[Route, ...] = (
    Route("web", "G-", "measurement_id", "secret-web"),
    Route("ios", "ios", "firebase_app_id", "secret-ios"),
    Route("android", None, "firebase_app_id", "secret-android"),
)

# Raw subscription event type -> outbound event name.
# Anything not listed maps to UNMAPPED_EVENT_NAME.
EVENT_NAMES: tuple[tuple[str, str], ...] = (
    ("Cancellation", "cancellation"),
    ("Request", "subs_request"),
    ("Renewal", "renewal"),
    ("PaymentSuccessful", "payment_successful"),
    ("PaymentFailed", "payment_failed"),
    ("PaymentDelayedSuspension", "payment_delayed_suspension"),
    ("PaymentDelayedGrace", "payment_delayed_grace"),
    ("InvoiceCreated", "invoice_created"),
    ("Creation", "creation"),
    ("ChangePayment", "change_payment"),
)
UNMAPPED_EVENT_NAME = "not available"

# Status labels, in classifier order (spelling is part of the
# payload contract).
STATUS_CHURN_VOLUNTARY = "churn voluntary"
STATUS_CHURN_INVOLUNTARY = "churn involuntary"
STATUS_CHURN_UNKNOWN = "churn unknown"
STATUS_IN_CANCELATION = "in cancelation period"
STATUS_ACTIVE = "active"
STATUS_UNKNOWN = "unknown"

# Sentinel dates used by the state query.
NO_DATE = dt.date(1900, 1, 1)
FAR_FUTURE = dt.date(2199, 12, 31)


@dataclass(frozen=True)
class SyncConfig:
    as_of: dt.datetime = dt.datetime(2024, 1, 31, 12, 0, tzinfo=dt.timezone.utc)
    zone: str = "Europe/Berlin"
    endpoint_base: str = "https://collect.example.invalid/mp"
    default_app_id: str = "G-DEFAULT0000"
    routes: tuple[Route, ...] = field(default=DEFAULT_ROUTES)
    # Fixed value: the hashed user key in the analytics tables is the
    # sha256 hex of this prefix followed by the raw user id.
    user_key_prefix: str = "google|"
    test_user_prefix: str = "dummy"
    snapshot_lookback_days: int = 7
    # days of analytics shards (ending today, local) read for the state job
    state_identity_days: int = 2
    # None = all shards (the event job reads the whole history)
    events_identity_days: int | None = None
    # Fixed value: name of the one event carried by every state payload.
    state_event_name: str = "update_subs_state_v1"
    target_batch_size: int = 29
    # events of one user are split over payloads of at most this many
    # events (the collection endpoint accepts 25 events per request)
    max_events_per_payload: int = 25
    # senders: as many tasks as send all payloads within send_seconds at the
    # rate of one sender, at most max_senders (the endpoint's limit);
    # send_partitions states their number instead
    sends_per_second: float = 50.0
    send_seconds: float = 600.0
    max_senders: int = 1_000
    send_partitions: int | None = None
    # a sender records what it sent after each of this many payloads
    send_record_every: int = 500
    # most bits of the bitmap of the day's users that is broadcast ahead of the
    # identity aggregate (2^27 bits are 16 MB)
    identity_filter_bits: int = 1 << 27
    # batching: an app with at most rows_per_range_partition payloads is
    # numbered in one task (plain ntile window); bigger inputs use that many
    # rows per range partition.  bucket_partitions forces the range form
    # with that many partitions.  Payloads are ~0.5-1 KB of JSON.
    bucket_partitions: int | None = None
    rows_per_range_partition: int = 500_000

    def __post_init__(self) -> None:
        if self.as_of.tzinfo is None:
            raise ValueError("as_of must be timezone-aware")
        if not self.routes or self.routes[-1].match is not None:
            raise ValueError("the last route must be the default (match=None)")
        if self.target_batch_size < 1 or self.max_events_per_payload < 1:
            raise ValueError("batch and payload sizes must be positive")

    @property
    def today_utc(self) -> dt.date:
        return self.as_of.astimezone(dt.timezone.utc).date()

    @property
    def today_local(self) -> dt.date:
        return self.as_of.astimezone(ZoneInfo(self.zone)).date()

    @property
    def yesterday_local(self) -> dt.date:
        return self.today_local - dt.timedelta(days=1)

    def shard(self, day: dt.date) -> str:
        return day.strftime("%Y%m%d")

    @property
    def state_shard_range(self) -> tuple[str, str]:
        lo = self.today_local - dt.timedelta(days=self.state_identity_days - 1)
        return self.shard(lo), self.shard(self.today_local)

    @property
    def events_shard_range(self) -> tuple[str | None, str]:
        """Never past today, so a past ``as_of`` reads what it read then."""
        if self.events_identity_days is None:
            return None, self.shard(self.today_local)
        lo = self.today_local - dt.timedelta(days=self.events_identity_days - 1)
        return self.shard(lo), self.shard(self.today_local)
