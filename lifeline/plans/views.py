"""The inputs and the lazy stages as temp views, for users who query with
``spark.sql``.  Views are plans: when they are made, only the churn types are
listed (a query fails if the snapshot has got others since; make them anew then).

    register_views(spark, inputs, cfg)
    spark.sql("SELECT subscription_status, count(*) FROM lifeline_subscription_state GROUP BY 1")
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lifeline.config import SyncConfig
from lifeline.plans import events_job, state_job
from lifeline.sources.inputs import Inputs


def register_views(
    spark: SparkSession, inputs: Inputs, cfg: SyncConfig, prefix: str = "lifeline_"
) -> list[str]:
    """Create or replace the temp views; returns their names.  Stages that
    need a sizing action first (identity key counts, batching) are left
    out, so registering stays cheap."""
    analytics = inputs.analytics.all().select(
        "event_id", "user_id", "user_pseudo_id", "event_timestamp",
        F.col("app_info.firebase_app_id").alias("firebase_app_id"), "suffix",
    )
    frames = {
        "snapshot": inputs.snapshot,
        "subscription_events": inputs.subscription_events,
        "analytics_events": analytics,
        "subscription_state": state_job.state_rows(inputs, cfg),
        "state_rows": state_job.state_with_identity(inputs, cfg),
        "state_projection": state_job.state_projection(inputs, cfg),
        "day_events": events_job.day_events(inputs, cfg),
    }
    names = []
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
