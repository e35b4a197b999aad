"""The original query shapes, kept only as brute-force references for the
equivalence tests (they put a whole user or a whole app into one window
partition, which the library forms avoid)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifeline.config import SyncConfig


def identity_by_windows(analytics: DataFrame, cfg: SyncConfig) -> DataFrame:
    """first_value windows per user, then DISTINCT."""
    by_user = Window.partitionBy("user_id")
    client_w = by_user.orderBy(
        F.when(F.col("user_pseudo_id").isNull(), 0).otherwise(1).desc(),
        "event_timestamp",
        "event_id",
    ).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    app_w = by_user.orderBy("event_timestamp", "event_id").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    first_app = F.first(F.col("app_info.firebase_app_id"), ignorenulls=False).over(app_w)
    return analytics.select(
        "user_id",
        F.first("user_pseudo_id", ignorenulls=False).over(client_w).alias("client_id"),
        F.when(first_app.isNull(), F.lit(cfg.default_app_id)).otherwise(first_app).alias("app_id"),
    ).distinct()


def latest_by_rank(snapshot: DataFrame, cfg: SyncConfig, lookback_start) -> DataFrame:
    paying = snapshot.where(
        (F.col("base_group") != "churn") & (F.col("calendar_date") >= F.lit(lookback_start))
    )
    w = Window.partitionBy("user_id").orderBy(F.col("calendar_date").desc())
    return paying.withColumn("_r", F.rank().over(w)).where("_r = 1").drop("_r")


def ntile_window(df: DataFrame, group_col: str, order_cols: list[str], n: int) -> DataFrame:
    w = Window.partitionBy(group_col).orderBy(*order_cols)
    return df.withColumn("bucket", F.ntile(n).over(w))
