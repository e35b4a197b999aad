"""Subscription event type -> outbound event name."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lifeline.config import EVENT_NAMES, UNMAPPED_EVENT_NAME


def event_custom_type(event_type: Column) -> Column:
    """First matching pair in ``EVENT_NAMES``; anything else (null included)
    becomes ``UNMAPPED_EVENT_NAME``."""
    out = None
    for raw, name in EVENT_NAMES:
        cond = event_type == raw
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(UNMAPPED_EVENT_NAME)
