"""Helpers shared by the operators: scratch tables and size-checked joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeline.session import checkpoint_dir

#: Rows of a narrow id table (a few dozen bytes each) that may be broadcast.
BROADCAST_ROWS = 500_000


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back: cuts the lineage
    and survives the loss of the executors that computed it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``save``, in buckets of ``key``: work by ``key`` needs no shuffle of
    these rows.  The catalog forgets the table at once; its files stay."""
    spark = df.sparkSession
    table = f"lifeline_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("compression", "zstd").option("path", scratch_path(spark, name)).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def maybe_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when its counted ``rows`` are within the
    bound; beyond it the join shuffles."""
    return F.broadcast(df) if rows <= limit else df


def sha256_hex(col: F.Column) -> F.Column:
    return F.sha2(col.cast("binary"), 256)


def hashed_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows, at most twice as many: those whose hash of ``keys``
    is below a bound set from the counted size.  Tasks send on only what is in
    the sample, however many tasks there are."""
    n = df.count()
    if n > rows:
        df = df.where(F.xxhash64(*keys) <= F.lit(-(2**63) + rows * 2**64 // n))
    return df.limit(2 * rows)
