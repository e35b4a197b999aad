"""Checks and previews over the batch table (all stay DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def batch_size_check(batch_df: DataFrame) -> DataFrame:
    """Per app: batch count, payload count (parsed from the JSON arrays) and
    the smallest and largest batch."""
    sized = batch_df.select("app_id", F.json_array_length("payload_array").alias("size"))
    return sized.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("size").cast("long").alias("n_payloads"),
        F.min("size").cast("long").alias("min_batch"),
        F.max("size").cast("long").alias("max_batch"),
    )


def first_batch(batch_df: DataFrame) -> DataFrame:
    return batch_df.orderBy("app_id", "bucket").limit(1)


def preview(batch_df: DataFrame, n: int = 20) -> DataFrame:
    return batch_df.orderBy("app_id", "bucket").limit(n)


def batch_roundtrip(batch_df: DataFrame, schema: T.StructType) -> DataFrame:
    """Batches parsed back into one row per payload (position kept)."""
    exploded = batch_df.select(
        "app_id",
        "bucket",
        F.posexplode(F.from_json("payload_array", T.ArrayType(schema))).alias("pos", "p"),
    )
    return exploded.select(
        "app_id",
        "bucket",
        F.col("pos").cast("int").alias("pos"),
        F.col("p.user_id").alias("user_id"),
        F.col("p.client_id").alias("client_id"),
        F.col("p.URL").alias("url"),
        F.size("p.events").alias("n_events"),
    )
