"""lifeline: subscription lifecycle sync on Spark.

Turns daily subscription snapshots, subscription events and day-sharded
app analytics events into routed, batched outbound payloads, and delivers
them through an injected transport into a ledger.

    from lifeline import SyncConfig, Inputs
    from lifeline.plans import daily
"""

from lifeline.config import Route, SyncConfig
from lifeline.sources.inputs import Inputs, load_testdata

__all__ = ["Route", "SyncConfig", "Inputs", "load_testdata"]
