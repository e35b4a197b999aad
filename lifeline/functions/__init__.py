"""Column-level building blocks (all built-in Spark expressions, so they
stay inside whole-stage codegen)."""

from lifeline.functions.dates import local_date, shard_suffix
from lifeline.functions.keys import hashed_user_key
from lifeline.functions.names import event_custom_type
from lifeline.functions.routing import route_columns
from lifeline.functions.status import subscription_status

__all__ = [
    "local_date",
    "shard_suffix",
    "hashed_user_key",
    "event_custom_type",
    "route_columns",
    "subscription_status",
]
