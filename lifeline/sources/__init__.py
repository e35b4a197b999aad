"""Inputs: fixed schemas, readers, and the bindings that derive the three
logical inputs from the generated test tables."""

from lifeline.sources.schemas import (
    ANALYTICS_EVENT_SCHEMA,
    SNAPSHOT_SCHEMA,
    SUBSCRIPTION_EVENT_SCHEMA,
)
from lifeline.sources.shards import ShardedEvents
from lifeline.sources.inputs import Inputs, load_testdata

__all__ = [
    "ANALYTICS_EVENT_SCHEMA",
    "SNAPSHOT_SCHEMA",
    "SUBSCRIPTION_EVENT_SCHEMA",
    "ShardedEvents",
    "Inputs",
    "load_testdata",
]
